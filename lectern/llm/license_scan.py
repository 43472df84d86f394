"""License notices by conditional compression: spans of a template's size are compressed with it as a dictionary, winners confirmed by their wording."""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lectern.llm.common import bounded_batches

#: Public license notices.
TEMPLATES: dict[str, str] = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "bsd-3-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-line": "Released under the BSD License.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-line": "Licensed under CC BY 4.0.",
    "cc-by-nc-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-line": "Licensed under CC BY-SA 4.0.",
    "cc0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "gpl-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "isc": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.',
    "mit": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "mit-line": "Released under the MIT License.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}
#: Words of which every template has one; a block is made of sentences with one.
CUES = "(?i)licen[sc]e|rights reserved|redistribut|permission|warrant|copyright|public domain|free software|neighboring rights|\\bMPL\\b|unencumbered|free to copy"
_CUE = re.compile(CUES)
_BREAK = re.compile(r"(?<=[.!?;:])\s+|\n+")
_WORD = re.compile(r"[a-z0-9][a-z0-9.+-]*(?<![.-])")
LEVEL = 19
#: A span is of a template from this reduction of the span's size on, and confirmed if at most this share of its words is changed or missing.
LEAST_REDUCTION, MOST_CHANGED = 0.08, 0.12
#: Sentences without a cue that may stand within a block.
GAP = 2


def blocks_of(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, block): runs of sentences with cues."""
    edges = [0, *(m.end() for m in _BREAK.finditer(text)), len(text)]
    first = last = None
    at = -1
    for at, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
        if not _CUE.search(text, a, b):
            continue
        if first is not None and at - last > GAP + 1:
            yield edges[first], edges[last + 1], text[edges[first] : edges[last + 1]]
            first = None
        first, last = at if first is None else first, at
    if first is not None:
        yield edges[first], edges[last + 1], text[edges[first] : edges[last + 1]]


def lowered(text: str) -> str:
    """Lower case, character by character, so that places stay."""
    return "".join(x if len(x := c.lower()) == 1 else c for c in text) if not text.isascii() else text.lower()


def words(text: str) -> list[str]:
    return _WORD.findall(lowered(text))


class Scanner:
    """Compressors for the templates, one for each raw dictionary and one without."""

    def __init__(self, templates: dict[str, str]) -> None:
        options = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.plain = zstandard.ZstdCompressor(**options)
        self.known, self.runs = [], {}
        for k, (name, template) in enumerate(templates.items()):
            made = zstandard.ZstdCompressionDict(template.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            made.precompute_compress(level=LEVEL)
            own = words(template)
            most = int(MOST_CHANGED * len(own))
            self.known.append((name, own, most, zstandard.ZstdCompressor(dict_data=made, **options)))
            run = max(1, -(-(len(own) - most) // (2 * most + 1)))  # a confirmed wording has an unchanged run of so many words
            for p in range(len(own) - run + 1):
                self.runs.setdefault(run, {}).setdefault(tuple(own[p : p + run]), []).append((k, p))

    def candidates(self, own: list[str]) -> Iterator[tuple[int, int]]:
        """(template, first word that it would have), wherever a run of its words stands."""
        found = set()
        for run, known in self.runs.items():
            for i in range(len(own) - run + 1):
                found.update((k, i - p) for k, p in known.get(tuple(own[i : i + run]), ()))
        return iter(sorted(found))

    def scan(self, text: str) -> list[tuple[int, int, str, float, int, bool]]:
        """(start, end, license, reduction, changed words, exact) of each confirmed notice, in order of block and bytes saved; reduction is the share of
        the notice's compressed size that the template saves. A template has as many notices as stand in a block."""
        out = []
        for start, end, block in blocks_of(text):
            spots = [m.span() for m in _WORD.finditer(lowered(block))]
            own, made = words(block), {}
            for k, first in self.candidates(own):
                name, template, most, compressor = self.known[k]
                at = max(0, first - most)
                found = wording(own[at : first + len(template) + most], template, set())
                if found is None:
                    continue
                changed, places = found[0], frozenset(at + x for x in found[1])
                if (name, places) not in made:
                    raw = block[spots[min(places)][0] : spots[max(places)][1]].encode()
                    size = len(self.plain.compress(raw))
                    made[name, places] = size - len(compressor.compress(raw)), size, changed
            taken: set[int] = set()
            for (name, places), (saved, size, changed) in sorted(made.items(), key=lambda x: (-x[1][0], x[1][2], x[0][0], min(x[0][1]))):
                if saved / size >= LEAST_REDUCTION and taken.isdisjoint(places):
                    taken |= places
                    out.append((start, end, name, saved / size, changed, changed == 0))
        return out


def wording(block: list[str], template: list[str], taken: set[int]) -> tuple[int, set[int]] | None:
    """(changed words, places in the block) where the template's words stand in order in words not yet taken; None if too many are changed."""
    most = int(MOST_CHANGED * len(template))
    matches = [m for m in SequenceMatcher(None, block, template, autojunk=False).get_matching_blocks() if m.size]
    matches = [m for m in matches if m.size > 1 or len(template) < 4]
    if not matches:
        return None
    places = {m.a + k for m in matches for k in range(m.size)}
    extra = max(places) - min(places) + 1 - len(places)
    changed = max(len(template) - len(places), extra)
    return None if changed > most or not places.isdisjoint(taken) else (changed, places)


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: dict[str, str] | None = None) -> DataFrame:
    """A row for each confirmed notice: doc_id, start, end (of its block, in code points), license, reduction, changed, exact.

    Texts without a cue are passed over in the JVM; whole texts of the others go to Python, one text at a time, however long: its work is in proportion to
    its words and to the spots where a run of a template's words stands. Null and empty texts have no notice, an empty table gives an empty one, and equal
    rows, null ids too, give equal rows. Of notices that share words the one that saves most stands, of ties the one with fewer changes, then the first by name.
    Other columns are not read. A narrow map."""
    bounded_batches(docs.sparkSession)
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text")).where(F.col("__text").rlike(CUES))
    schema = StructType([source.schema["doc_id"], *StructType.fromDDL("start bigint, end bigint, license string, reduction double, changed bigint, exact boolean")])
    known = templates or TEMPLATES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(known)
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.bool_())
        for batch in batches:
            rows = [(i, *x) for i, body in enumerate(batch.column(1).to_pylist()) for x in scanner.scan(body)]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(columns[0], pa.int64())), *(pa.array(c, k) for c, k in zip(columns[1:], kinds, strict=True))], names=schema.names)

    return source.mapInArrow(run, schema)
