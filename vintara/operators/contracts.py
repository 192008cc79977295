"""Fail-closed contracts: nine rules over rows of a table, typed or as JSON texts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Vocabularies, forbidden fields and the time roles that each type of table needs.
STATUS = ["vermutet", "beobachtet", "erwiesen"]
FORBIDDEN = ["knoten_id"]
TIME_ROLES = {
    "beobachtung": ["t_event", "t_disclosed", "t_ingest"],
    "projektion": ["t_ref", "t_ingest"],
    "referenz": ["t_valid_von", "t_valid_bis", "t_ingest"],
    "walkforward": ["t_valid_von", "t_ingest"],
    "operativ": ["t_ingest"],
}
KINDS = ("id", "version", "time", "ordinal", "status", "enum", "gemessen", "abgeleitet", "text", "bool", "list")


@dataclass(frozen=True)
class Field:
    """One declared field."""

    name: str
    kind: str
    enum: tuple[str, ...] | None = None
    nullable: bool = False


@dataclass(frozen=True)
class TableContract:
    """Name, type of table, fields and key of a table."""

    name: str
    art: str
    fields: list[Field] = field(default_factory=list)
    key: tuple[str, ...] = ()


def contract_violations(contract: TableContract) -> list[tuple[str | None, str, str]]:
    """``(field, rule, detail)`` that the contract itself breaks; the first rule ends the check."""
    if contract.art not in TIME_ROLES:
        return [(None, "unbekannter-tabellen-typ", contract.art)]
    names = {f.name for f in contract.fields}
    out = [(r, "zeit-spalte-fehlt-im-kontrakt", contract.art) for r in TIME_ROLES[contract.art] if r not in names]
    return out + [(f, "verbotenes-feld", "im Kontrakt") for f in FORBIDDEN if f in names]


def validate(rows: DataFrame, contract: TableContract, json_col: str = "row", index_col: str = "row_index") -> DataFrame:
    """``row_index, field, rule``: every violation of rows given as JSON objects in one column.

    JSON keeps what a typed column loses: whether a key is there, and the type of its value.
    ``row_index`` -1 marks violations of the contract itself. A row may break many rules.
    """
    spark = rows.sparkSession
    own = contract_violations(contract)
    head = spark.createDataFrame([(-1, f, r) for f, r, _ in own], "row_index long, field string, rule string")
    if own and own[0][1] == "unbekannter-tabellen-typ":
        return head
    names = sorted({*FORBIDDEN, *TIME_ROLES[contract.art], "kat_id", "version", *(f.name for f in contract.fields)})
    # a text is parsed once: what stands in an array of one is not inlined into what reads it
    parsed = rows.select(F.col(index_col).cast("long").alias("row_index"), F.explode(F.array(F.try_parse_json(json_col))).alias("v"))
    at = lambda k, kind: F.try_variant_get("v", f"$.{k}", kind)
    seen = parsed.select("row_index", F.inline(F.array(F.struct(*[x for i, k in enumerate(names) for x in (F.schema_of_variant(at(k, "variant")).alias(f"k{i}"), at(k, "string").alias(f"t{i}"))]))))
    kind_of = {k: F.col(f"k{i}") for i, k in enumerate(names)}
    text = {k: F.col(f"t{i}") for i, k in enumerate(names)}
    facts = {k: (kind_of[k].isNotNull(), text[k].isNull() & ~F.coalesce(kind_of[k].rlike("^(ARRAY|OBJECT)"), F.lit(False)), F.coalesce(kind_of[k].rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.lit(False)), text[k]) for k in names}
    found = _broken(seen, contract, facts)
    return head.union(found) if own else found


def _broken(rows: DataFrame, contract: TableContract, facts: dict) -> DataFrame:
    """``row_index, field, rule`` of the rules that rows break; ``facts`` as of ``_checks``."""
    return rows.select("row_index", F.explode(_checks(contract, facts)).alias("x")).select("row_index", "x.field", "x.rule")


def _checks(contract: TableContract, facts: dict) -> Column:
    """Array of ``field, rule`` that a row breaks; ``facts`` has per name whether it is there, is null, is a number, and its text."""
    there_, null_, number_, text_ = ({k: f[i] for k, f in facts.items()} for i in range(4))
    checks = []
    rule = lambda cond, f, r: F.when(cond, F.struct(F.lit(f).alias("field"), F.lit(r).alias("rule")))
    for f in FORBIDDEN:
        checks.append(rule(there_[f], f, "verbotenes-feld"))
    for r in TIME_ROLES[contract.art]:
        checks.append(rule(null_[r] | F.coalesce(text_[r] == "", F.lit(False)), r, "zeit-spalte-fehlt"))
    checks.append(rule(there_["kat_id"] & ~there_["version"], "version", "id-version-paarung"))
    for f in contract.fields:
        if f.name in TIME_ROLES[contract.art]:
            continue
        gone = null_[f.name]
        blank = text_[f.name].eqNullSafe(F.lit("")) if f.kind not in ("list", "bool") else F.lit(False)
        if not f.nullable:
            checks.append(rule(gone | blank, f.name, "pflichtfeld-fehlt-oder-null"))
        there = ~gone if f.nullable else ~(gone | blank)
        if f.kind in ("ordinal", "status", "enum"):
            checks.append(rule(there & number_[f.name], f.name, "ordinal-als-zahl"))
            words = STATUS if f.kind == "status" else list(f.enum) if f.enum else None
            if words:
                checks.append(rule(there & ~number_[f.name] & ~F.coalesce(text_[f.name].isin(words), F.lit(False)), f.name, "wert-nicht-im-vokabular"))
        if f.kind == "gemessen":
            checks.append(rule(there & ~number_[f.name], f.name, "gemessen-nicht-numerisch"))
    none = F.lit(None).cast("struct<field:string,rule:string>")
    return F.array_compact(F.array(*checks, none))


def _typed_facts(df: DataFrame, contract: TableContract, besides: tuple[str, ...] = ()) -> dict:
    """The facts of ``_checks`` by the types of columns."""
    kinds = {f.name: f.dataType for f in df.schema.fields if f.name not in besides}
    facts = {}
    for k in {*FORBIDDEN, *TIME_ROLES[contract.art], "kat_id", "version", *(f.name for f in contract.fields)}:
        if k not in kinds:
            facts[k] = (F.lit(False), F.lit(True), F.lit(False), F.lit(None).cast("string"))
            continue
        c, kind = F.col(f"`{k}`"), kinds[k]
        nested = isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))
        facts[k] = (c.isNotNull(), c.isNull(), c.isNotNull() if isinstance(kind, T.NumericType) else F.lit(False), F.lit(None).cast("string") if nested else c.cast("string"))
    return facts


def broken_rules(df: DataFrame, contract: TableContract) -> Column:
    """A column of ``df``: the array of ``field, rule`` that a typed row breaks, empty for a good one; needs no other pass over the rows."""
    return _checks(contract, _typed_facts(df, contract))


def validate_typed(df: DataFrame, contract: TableContract, index_col: str) -> DataFrame:
    """``validate`` for typed rows, by the types of the columns; a null column counts as an absent key.

    Numeric columns are numbers, those that hold NaN among them; booleans and texts are none.
    """
    own = contract_violations(contract)
    head = df.sparkSession.createDataFrame([(-1, f, r) for f, r, _ in own], "row_index long, field string, rule string")
    if own and own[0][1] == "unbekannter-tabellen-typ":
        return head
    facts = _typed_facts(df, contract, (index_col,))
    found = _broken(df.withColumn("row_index", F.col(index_col).cast("long")), contract, facts)
    return head.union(found) if own else found
