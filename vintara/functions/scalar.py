"""Scalar functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Source types and the rung of the source ladder that each belongs to.
SOURCE_RUNGS = {
    "arxiv": "paper", "openalex": "paper", "paper": "paper", "wissenschaft": "paper",
    "epo": "patent", "patent": "patent",
    "edgar": "funding", "formd": "funding", "form_d": "funding", "form-d": "funding", "funding": "funding", "seed": "funding",
    "rss": "news", "eqs": "news", "adhoc": "news", "adhoc_mitteilung": "news", "news": "news",
}
# Legal forms and collective words dropped from the end of a company name.
LEGAL_FORMS = ["inc", "incorporated", "corp", "corporation", "company", "co", "ltd", "limited", "llc", "plc", "gmbh", "ag", "se", "sa", "nv", "spa", "holdings", "holding", "group"]


def source_rung(source: Column) -> Column:
    """paper, patent, funding or news; unknown and null sources are news."""
    rungs = F.create_map(*[F.lit(x) for kv in SOURCE_RUNGS.items() for x in kv])
    return F.coalesce(F.try_element_at(rungs, F.lower(F.trim(F.coalesce(source, F.lit(""))))), F.lit("news"))


def collapse_space(text: Column) -> Column:
    """Every run of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def canonical_entity(name: Column, aliases: Column | None = None) -> Column:
    """Company name without legal forms at its end; ``aliases`` maps lower-case names to canonical ones.

    The last word is never dropped; a name that would be a legal form alone, or empty, stays whole.
    """
    raw = collapse_space(F.coalesce(name, F.lit("")))
    words = F.split(raw, " ")
    bare = lambda w: F.regexp_replace(F.lower(w), r"^[.,]+|[.,]+$", "")
    forms = F.array(*[F.lit(f) for f in LEGAL_FORMS])
    # the number of words that stay: the last place that is no legal form, at least one
    keep = F.greatest(F.lit(1), F.coalesce(F.array_max(F.transform(words, lambda w, i: F.when(~F.array_contains(forms, bare(w)), i + 1))), F.lit(1)))
    kept = F.slice(words, 1, keep)
    clean = F.regexp_replace(F.array_join(kept, " "), r"^[ ,.]+|[ ,.]+$", "")
    core = F.when((clean == "") | ((keep == 1) & F.array_contains(forms, bare(F.get(kept, F.lit(0))))), raw).otherwise(clean)
    if aliases is None:
        return core
    look = lambda x: F.nullif(F.try_element_at(aliases, F.lower(x)), F.lit(""))
    return F.when(raw == "", F.lit("")).otherwise(F.coalesce(look(raw), look(core), core))


def content_hash(title: Column, text: Column) -> Column:
    """First 16 hex digits of SHA-256 over title, blank, text."""
    return F.substring(F.sha2(F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(text, F.lit(""))), 256), 1, 16)


def iso_day(text: Column) -> Column:
    """The date that a text starts with in full ISO form, else null; partial dates are no dates."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(text, 1, 10).try_cast("date"))


def patent_ref(patent_id: Column) -> Column:
    """``CC.NUMBER.KIND`` from a joined patent id, else null."""
    shape = r"^([A-Za-z]{2})(\d+)([A-Za-z]\d*)$"
    return F.when(patent_id.rlike(shape), F.concat_ws(".", *[F.regexp_extract(patent_id, shape, i) for i in (1, 2, 3)]))


#: What reads as a number: decimal digits with sign, point and exponent, or a word for infinity or no number; no type suffixes.
NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def number(text: Column) -> Column:
    """The double that a text reads as, else null."""
    return F.when(text.rlike(NUMBER), F.trim(F.regexp_replace(text, r"^\s+|\s+$", "")).try_cast("double"))


def is_number(text: Column) -> Column:
    """Whether a text reads as a number."""
    return number(text).isNotNull()


def strip(text: Column) -> Column:
    """``text`` without any white space at its ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def first_of(*values: Column) -> Column:
    """The first value that is neither null nor the empty text."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])


def compact_day(text: Column) -> Column:
    """``YYYYMMDD`` from an ISO day; a compact day stays as it is."""
    return F.replace(text, F.lit("-"), F.lit(""))


def day_of_compact(text: Column) -> Column:
    """ISO day from the first eight digits of a text; empty where it has fewer, null included."""
    digits = F.regexp_replace(F.coalesce(text, F.lit("")), r"\D", "")
    return F.when(F.length(digits) >= 8, F.concat_ws("-", F.substring(digits, 1, 4), F.substring(digits, 5, 2), F.substring(digits, 7, 2))).otherwise(F.lit(""))


def fact_number(text: Column) -> Column:
    """123 from ``fakt123`` in any case, or from ``123``; null where neither."""
    return F.regexp_extract(strip(text.cast("string")), r"(?i)^(?:fakt)?([+-]?\d+)$", 1).try_cast("long")


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors in double precision; 0 for empty, zero or unequally long ones."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, p: s + p)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when((F.size(a) == F.size(b)) & (F.size(a) > 0) & (norm > 0), dot(a, b) / norm).otherwise(F.lit(0.0))


def matches_prefix(code: Column, prefixes: list[str]) -> Column:
    """Whether a code starts with one of the prefixes; null and empty codes do not."""
    out = F.lit(False)
    for p in prefixes:
        out = out | code.startswith(p)
    return F.coalesce(out & (code != ""), F.lit(False))
