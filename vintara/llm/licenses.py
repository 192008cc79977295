"""Operator 7: licence scan by sentence rules.

Each text is cut into sentences, each sentence normalised and looked up among known licence
sentences; the sequence of identifiers found is matched against ordered rules. A rule holds
where its identifiers occur in order with at most ``GAP`` other sentences between two.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_text, map_arrow, table

#: Licences that are mostly named: SPDX identifier -> names, without "license" at the end. Wordings follow from ``naming``.
NAMES: dict[str, list[str]] = {
    "MIT": ["mit", "mit expat", "expat"],
    "Apache-2.0": ["apache version 2 0", "apache 2 0", "apache license version 2 0", "apache license 2 0", "asl 2 0"],
    "GPL-3.0": ["gnu general public license version 3", "gnu general public license v3", "gnu general public license v3 0", "gnu gpl version 3", "gnu gpl v3", "gpl version 3", "gpl v3", "gplv3"],
    "GPL-2.0": ["gnu general public license version 2", "gnu general public license v2", "gnu general public license v2 0", "gnu gpl version 2", "gnu gpl v2", "gpl version 2", "gpl v2", "gplv2"],
    "LGPL-3.0": ["gnu lesser general public license version 3", "gnu lesser general public license v3", "gnu lgpl version 3", "gnu lgpl v3", "lgpl v3", "lgplv3"],
    "LGPL-2.1": ["gnu lesser general public license version 2 1", "gnu lesser general public license v2 1", "gnu lgpl version 2 1", "gnu lgpl v2 1", "lgpl v2 1"],
    "AGPL-3.0": ["gnu affero general public license version 3", "gnu affero general public license v3", "gnu agpl version 3", "gnu agpl v3", "agpl v3", "agplv3"],
    "BSD-3-Clause": ["bsd 3 clause", "3 clause bsd", "new bsd", "modified bsd"],
    "BSD-2-Clause": ["bsd 2 clause", "2 clause bsd", "simplified bsd", "freebsd"],
    "0BSD": ["bsd zero clause", "zero clause bsd"],
    "ISC": ["isc"],
    "MPL-2.0": ["mozilla public license version 2 0", "mozilla public license v 2 0", "mozilla public license 2 0", "mpl 2 0"],
    "EPL-2.0": ["eclipse public license version 2 0", "eclipse public license v 2 0", "eclipse public license 2 0"],
    "EPL-1.0": ["eclipse public license version 1 0", "eclipse public license v1 0"],
    "CDDL-1.0": ["common development and distribution license version 1 0", "cddl 1 0"],
    "BSL-1.0": ["boost software license version 1 0", "boost software license 1 0", "boost software"],
    "Artistic-2.0": ["artistic license 2 0", "artistic license version 2 0"],
    "Zlib": ["zlib"],
    "Unlicense": ["unlicense"],
    "WTFPL": ["do what the fuck you want to public license version 2", "wtfpl"],
    "PSF-2.0": ["python software foundation license version 2", "psf license version 2"],
    "OFL-1.1": ["sil open font license version 1 1", "sil open font"],
    "EUPL-1.2": ["european union public licence v 1 2", "european union public licence version 1 2", "eupl v 1 2"],
    "ODbL-1.0": ["open database license v1 0", "open data commons open database license", "open database"],
    "CC0-1.0": ["cc0 1 0", "cc0 1 0 universal", "creative commons zero v1 0 universal"],
    "CC-BY-4.0": ["cc by 4 0", "creative commons attribution 4 0 international"],
    "CC-BY-SA-4.0": ["cc by sa 4 0", "creative commons attribution sharealike 4 0 international"],
    "CC-BY-NC-4.0": ["cc by nc 4 0", "creative commons attribution noncommercial 4 0 international"],
    "CC-BY-ND-4.0": ["cc by nd 4 0", "creative commons attribution noderivatives 4 0 international"],
    "CC-BY-NC-SA-4.0": ["cc by nc sa 4 0", "creative commons attribution noncommercial sharealike 4 0 international"],
    "CC-BY-NC-ND-4.0": ["cc by nc nd 4 0", "creative commons attribution noncommercial noderivatives 4 0 international"],
    "CC-BY-3.0": ["cc by 3 0", "creative commons attribution 3 0 unported"],
    "CC-BY-SA-3.0": ["cc by sa 3 0", "creative commons attribution sharealike 3 0 unported"],
}
#: Identifiers of the naming sentences that differ from the licence's lower-case name.
_SHORT = {"Apache-2.0": "apache2", "GPL-3.0": "gpl3", "GPL-2.0": "gpl2", "LGPL-3.0": "lgpl", "AGPL-3.0": "agpl", "BSD-3-Clause": "bsd3", "BSD-2-Clause": "bsd2", "MPL-2.0": "mpl2", "CC-BY-NC-4.0": "cc-by-nc4", "CC-BY-4.0": "cc-by4", "CC-BY-SA-4.0": "cc-by-sa4", "CC0-1.0": "cc0"}


def naming(licence: str) -> list[str]:
    """The sentences that name a licence, normalised: alone, licensed under it, by its SPDX identifier."""
    out = []
    for name in NAMES[licence]:
        ends = [name] if name.endswith(("license", "licence")) else [name, f"{name} license"]
        for x in ends:
            # a bare name is a sentence of its own only where it can mean nothing else
            alone = [x, f"the {x}"] if x.endswith(("license", "licence")) or any(c.isdigit() for c in x) else []
            verbs = [f"{v} under {the}{x}" for v in ("licensed", "released", "distributed", "made available") for the in ("", "the ", "a ")]
            whole = [f"{what} is {v}" for what in ("this project", "this work", "this software", "this program", "this file", "this code") for v in verbs]
            out += [*alone, *verbs, *whole]
    spdx = normalise(licence)
    return out + [f"spdx license identifier {spdx}{tail}" for tail in ("", " only", " or later")]


def name_id(licence: str) -> str:
    """Identifier of the sentences that name a licence."""
    return _SHORT.get(licence, licence.lower()) + "-name"


#: Other known licence sentences, normalised as ``normalise`` does: identifier -> wordings.
SENTENCES: dict[str, list[str]] = {
    "mit-grant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"],
    "mit-notice": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "apache2-name": ["licensed under the apache license version 2 0 the license", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"],
    "apache2-comply": ["you may not use this file except in compliance with the license"],
    "apache2-asis": ["unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"],
    "gpl3-redistribute": [f"{start}you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version" for start in ("", "this program is free software ")],
    "gpl2-redistribute": [f"{start}you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version" for start in ("", "this program is free software ")],
    "gpl-redistribute": [f"{start}you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation" for start in ("", "this program is free software ")],
    "gpl-warranty": ["this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"],
    "agpl3-redistribute": [f"{start}you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version" for start in ("", "this program is free software ")],
    "lgpl3-redistribute": [f"{start}you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version" for start in ("", "this program is free software ", "this library is free software ")],
    "bsd-redistribute": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "bsd-source": [f"{mark}redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer" for mark in ("", "1 ", "a ")],
    "bsd-binary": [f"{mark}redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution" for mark in ("", "2 ", "b ")],
    "bsd-endorse": [f"{mark}neither the name of the {holder} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission" for mark in ("", "3 ", "c ") for holder in ("copyright holder", "author", "organization")],
    "isc-grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"],
    "0bsd-grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"],
    "zlib-grant": ["permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"],
    "boost-grant": ["permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following"],
    "mpl2-name": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
    "epl2-terms": ["this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at"],
    "cc0-waiver": ["to the extent possible under law the author has waived all copyright and related rights to this work", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "reserved": ["all rights reserved"],
}
#: Ordered rules: licence -> sequences of identifiers, each of which is enough. Every licence also holds where it is named.
RULES: dict[str, list[tuple[str, ...]]] = {
    "MIT": [("mit-grant", "mit-notice")],
    "Apache-2.0": [("apache2-comply", "apache2-asis")],
    "GPL-3.0": [("gpl3-redistribute",), ("gpl-redistribute", "gpl-warranty", "gpl3-name")],
    "GPL-2.0": [("gpl2-redistribute",)],
    "GPL": [("gpl-redistribute", "gpl-warranty")],
    "AGPL-3.0": [("agpl3-redistribute",)],
    "LGPL-3.0": [("lgpl3-redistribute",)],
    "BSD-3-Clause": [("bsd-redistribute", "bsd-source", "bsd-binary", "bsd-endorse")],
    "BSD-2-Clause": [("bsd-redistribute", "bsd-source", "bsd-binary")],
    "ISC": [("isc-grant",)],
    "0BSD": [("0bsd-grant",)],
    "Zlib": [("zlib-grant",)],
    "BSL-1.0": [("boost-grant",)],
    "EPL-2.0": [("epl2-terms",)],
    "CC0-1.0": [("cc0-waiver",)],
    "Unlicense": [("unlicense",)],
    "Proprietary": [("reserved",)],
}
GAP = 3
_CUT = re.compile(r"\n\s*\n|(?<=[.;:!?])\s+|[.;:!?]?\n")
_NOT_WORD = re.compile(r"[\W_]+")


def normalise(sentence: str) -> str:
    """Lower case, words only, single spaces."""
    return _NOT_WORD.sub(" ", sentence.lower()).strip()


for _licence in NAMES:
    SENTENCES[name_id(_licence)] = SENTENCES.get(name_id(_licence), []) + naming(_licence)
    RULES[_licence] = [(name_id(_licence),)] + RULES.get(_licence, [])
_KNOWN = {w: k for k, ws in SENTENCES.items() for w in ws}
#: Every run of words that a known sentence starts with.
_STARTS = {" ".join(w[: i + 1]) for w in map(str.split, _KNOWN) for i in range(len(w))}
#: A sentence can only be known if it holds one of these stems; the check is on the raw text.
_STEMS = re.compile(r"licen[cs]e|permission|notice|redistribut|warrant|rights|public domain|endorse|complian", re.I)


def sentences(text: str) -> Iterator[tuple[int, str]]:
    """Offset and text of each sentence: between line ends, and after sentence marks followed by white space."""
    at = 0
    for m in _CUT.finditer(text):
        if m.start() > at or m.group()[:1] in ".;:!?":
            yield at, text[at : m.end()]
        at = m.end()
    if at < len(text):
        yield at, text[at:]


def identifiers(text: str) -> list[tuple[int, int, int, str]]:
    """``(sentence number, start, end, identifier)`` of each known licence sentence.

    A sentence may run over any number of pieces, so wordings broken by line ends or a mark
    inside ("Version 2.0", "Free Software Foundation, either ...") are found; the longest wins.
    Pieces without words are no sentences, and a known sentence counts as one.
    """
    if not _STEMS.search(text):
        return []
    pieces = [(at, s, norm) for at, s in sentences(text) if (norm := normalise(s))]
    found, i, no = [], 0, 0
    while i < len(pieces):
        best, joined = None, ""
        for j in range(i, len(pieces)):
            joined = f"{joined} {pieces[j][2]}" if joined else pieces[j][2]
            if joined not in _STARTS:
                break
            if joined in _KNOWN:
                best = (j, _KNOWN[joined])
        if best:
            j, name = best
            found.append((no, pieces[i][0], pieces[j][0] + len(pieces[j][1].rstrip()), name))
            i = j + 1
        else:
            i += 1
        no += 1
    return found


def _follow(found: list[tuple[int, int, int, str]], at: int, wants: tuple[str, ...]) -> tuple[int, int, int, str] | None:
    """The last sentence of the earliest way to go on from ``found[at]`` through ``wants``, or none."""
    if not wants:
        return found[at]
    for i in range(at + 1, len(found)):
        if found[i][0] - found[at][0] > GAP + 1:
            break
        if found[i][3] == wants[0] and (last := _follow(found, i, wants[1:])):
            return last
    return None


def licences(found: list[tuple[int, int, int, str]]) -> list[tuple[str, int, int]]:
    """``(licence, start, end)`` of the rules that hold, in order of place.

    Hits of one licence that overlap, or have at most ``GAP`` other sentences between them,
    are one statement of it and are merged; a hit inside another licence's longer one is
    dropped. Sentences that repeat far apart give a hit each.
    """
    out = []  # licence, first and last sentence, start, end
    for name, seqs in RULES.items():
        hits = []
        for seq in seqs:
            for i, (no, start, end, first) in enumerate(found):
                if first == seq[0] and (last := _follow(found, i, seq[1:])):
                    hits.append((no, last[0], start, last[2]))
        merged: list[list[int]] = []
        for no, to, start, end in sorted(hits):
            if merged and no - merged[-1][1] <= GAP + 1:
                merged[-1][1], merged[-1][3] = max(merged[-1][1], to), max(merged[-1][3], end)
            else:
                merged.append([no, to, start, end])
        out += [(name, start, end) for _, _, start, end in merged]
    best = [x for x in out if not any(y[0] != x[0] and y[1] <= x[1] and y[2] >= x[2] and (y[2] - y[1]) > (x[2] - x[1]) for y in out)]
    return sorted(set(best), key=lambda x: (x[1], x[2], x[0]))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, licenses, starts, ends, sentence_ids``, a row per input row.

    ``licenses`` are the rules that hold, in order of place (``licences``), with the code point
    offsets of each match; matches of one place are in order of their names. ``sentence_ids``
    is the sequence of known sentences. Whole texts are read, however long. Null and empty
    texts have empty lists; rows that repeat give rows that repeat. Other columns are not
    read, whatever they are called.
    """
    base = id_text(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [identifiers(t) for t in b.column("text").to_pylist()]
            got = [licences(f) for f in ids]
            cols = [[[x[k] for x in g] for g in got] for k in range(3)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(cols[0], pa.list_(pa.string())), pa.array(cols[1], pa.list_(pa.int64())), pa.array(cols[2], pa.list_(pa.int64())), pa.array([[x[3] for x in f] for f in ids], pa.list_(pa.string()))], ["doc_id", "licenses", "starts", "ends", "sentence_ids"])

    return map_arrow(base, run, f"doc_id {dict(base.dtypes)['doc_id']}, licenses array<string>, starts array<bigint>, ends array<bigint>, sentence_ids array<string>")


def query(spark, sf_dir: str) -> DataFrame:
    """Registered query ``op7_license_scan``; the lists are joined by commas."""
    from pyspark.sql import functions as F

    out = scan(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.size("licenses").cast("long").alias("n_licenses"), F.array_join("licenses", ",").alias("licenses"), F.array_join("sentence_ids", ",").alias("sentence_ids"))
