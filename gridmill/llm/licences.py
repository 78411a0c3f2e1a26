"""Licence notices in texts: MinHash bands over overlapping windows retrieve templates, exact containment verifies them.

Words are lower-cased and compared without ASCII punctuation at their ends, so comment marks do not matter. A template's set
holds its runs of five words, one of fewer than ten words its runs of three. Templates of up to ``w`` runs, w a power of two,
are looked for in windows of 2w runs that begin every w runs: any stretch of w runs lies whole in one of them.

A window that holds ``LEAST`` of a template has a similarity of at least 0.18 with it (0.5 * LEAST / (1 + 0.1) for w of half
the size and more; 1 for a single run). With ``BANDS`` bands of one register each, it is missed with probability
(1 - 0.18)**BANDS = 3e-6 at most. A window's registers are minima of the registers of its two halves.

A pair is verified on the exact runs around the window: the share of the template's distinct runs there must reach ``LEAST``.
Half of the runs that a relative of another name lacks must be among them, and a run with the number that a short notice names. Of
templates found at the same words, the one with most of them is given.

Null and empty texts hold no notice. Rows that share a number are scanned each. Empty tables give no rows. Other columns are not
read. Templates are a parameter of at most ``MAX_BYTES`` together; more must be scanned in several calls.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gridmill.llm.decontamination import SOLID, plain_words
from gridmill.llm.textarrays import Texts, chunks, shingles

SHINGLE, BANDS, LEAST = 5, 64, 0.8
#: Templates of fewer words are sets of shorter runs; the words of a notice that may name one version.
SHORT, SHORT_SHINGLE, NAMED = 10, 3, 40
MAX_BYTES = 16 << 20

#: Short public notices, by their usual short names.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
                   "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
                   "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
                   "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
            "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
            "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
            "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
            "is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be "
            "included in all copies or substantial portions of the Software."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
            "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
            "following disclaimer."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("Proprietary", "All rights reserved."),
)

_TEXTS = Path(__file__).parent / "licence_texts"
_AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
          "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
          "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
          "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_UNLICENSE = ("This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
              "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.")
_EPL = ("This program and the accompanying materials are made available under the terms of the Eclipse Public License v{0} which accompanies this "
        "distribution, and is available at")
_GNU = (("GPL", "General", ("1", "2", "3")), ("LGPL", "Library General", ("2",)), ("LGPL", "Lesser General", ("2.1", "3")), ("AGPL", "Affero General", ("3",)))
_SPDX = ("Apache-2.0 MIT ISC 0BSD BSD-2-Clause BSD-3-Clause MPL-1.1 MPL-2.0 EPL-1.0 EPL-2.0 CC0-1.0 Unlicense Zlib BSL-1.0 GPL-2.0 GPL-2.0-only "
         "GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later "
         "AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later").split()


def _family() -> Iterator[tuple[str, str]]:
    """Names and texts of the usual licences and versions: whole texts, headers and one-line notices."""
    mit = dict((n, t) for n, t in NOTICES if len(t) > 300)["MIT"]
    yield "MIT", f"{mit} {_AS_IS}"
    for name, full in (("MIT", "MIT"), ("ISC", "ISC"), ("Zlib", "zlib"), ("BSL-1.0", "Boost Software"), ("BSD-2-Clause", "BSD 2-Clause"), ("BSD-3-Clause", "BSD 3-Clause")):
        yield name, f"under the {full} License"
    yield "ISC", (dict(NOTICES)["ISC"] + " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
                  "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.")
    yield "Unlicense", _UNLICENSE
    for v in ("1.0", "2.0"):
        yield f"EPL-{v}", _EPL.format(v)
        yield f"EPL-{v}", _EPL.format(f" {v}")
        yield f"EPL-{v}", f"under the Eclipse Public License, version {v}"
    for v in ("1.1", "2.0"):
        yield f"MPL-{v}", f"under the Mozilla Public License, version {v}"
        yield f"Apache-{v}", f"under the Apache License, Version {v}"
    bsd = (_TEXTS / "BSD.txt").read_text()
    bsd = bsd[bsd.index("Redistribution and use"):]
    for holder, party in (("University", "REGENTS"), ("copyright holder", "COPYRIGHT HOLDERS")):
        three = bsd.replace("University", holder).replace("REGENTS", party)
        yield "BSD-3-Clause", three
        yield "BSD-2-Clause", three[: three.index("3. Neither")] + three[three.index("THIS SOFTWARE"):]
    for short, kind, versions in _GNU:
        for v in versions:
            name, full = f"{short}-{v}" + ("" if "." in v else ".0"), f"GNU {kind} Public License"
            yield name, f"This work is licensed under the {full}, version {v}."
            yield name, f"under the {full}, version {v}"
            yield f"{name}-or-later", ("This program is free software: you can redistribute it and/or modify it under the terms of the "
                                       f"{full} as published by the Free Software Foundation, either version {v} of the License, or (at your option) any later version.")
            yield f"{name}-only", ("This program is free software: you can redistribute it and/or modify it under the terms of the "
                                   f"{full} version {v} as published by the Free Software Foundation.")
    for parts in ((), ("NC",), ("SA",), ("ND",), ("NC", "SA"), ("NC", "ND")):
        for v, area in (("1.0", "Generic"), ("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"), ("4.0", "International")):
            code = "-".join(("BY", *parts))
            words = {"NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives" if v == "4.0" else "NoDerivs"}
            full = "-".join(("Attribution", *(words[x] for x in parts)))
            yield f"CC-{code}-{v}", f"Licensed under CC {code} {v}."
            yield f"CC-{code}-{v}", f"under CC {code} {v}"
            yield f"CC-{code}-{v}", f"under a Creative Commons {full} {v} License"
            yield f"CC-{code}-{v}", f"This work is licensed under a Creative Commons {full} {v} {area} License."
            yield f"CC-{code}-{v}", f"SPDX-License-Identifier: CC-{code}-{v}"
    for name in _SPDX:
        yield name, f"SPDX-License-Identifier: {name}"
    for path in sorted(_TEXTS.glob("*-*.txt")):
        name = path.stem if "." in path.stem else f"{path.stem}.0"
        yield name, path.read_text()
    # The text differs from that of the GPL by its name and one section, far less than what may be missing.
    yield "AGPL-3.0", (_TEXTS / "GPL-3.txt").read_text().replace("GNU General", "GNU Affero General").replace("GNU GENERAL", "GNU AFFERO GENERAL")
    yield "Artistic-1.0", (_TEXTS / "Artistic.txt").read_text()


#: Notices, headers and texts that are looked for unless others are given.
TEMPLATES = (*NOTICES, *(x for x in dict.fromkeys(_family()) if x not in NOTICES))

_FACTORS = np.random.Generator(np.random.PCG64(907)).integers(0, 1 << 31, BANDS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def _registers(values: np.ndarray) -> np.ndarray:
    """Register values of single runs [band, run]; their minimum over a set is its MinHash."""
    low = (values & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    high = (values >> np.uint64(32)).astype(np.uint32)
    return np.stack([low * f ^ high for f in _FACTORS])


class Templates:
    """Sets of all templates, the runs that tell them from their relatives, and by run size and length the registers that retrieve them."""

    def __init__(self, templates):
        self.name, self.sets, self.size, self.dated, kinds = [], [], [], [], {}
        for name, text in templates:
            texts = next(chunks(pa.array([text])))
            word, doc = plain_words(texts)
            if not len(word):
                continue
            k = min(SHINGLE if len(word) >= SHORT else SHORT_SHINGLE, len(word))
            runs, at = shingles(word, doc, k)
            own = np.unique(runs)
            w = 1 << (len(own) - 1).bit_length()
            kinds.setdefault(k, {}).setdefault(w, []).append(len(self.sets))
            self.name.append(name)
            self.sets.append(own)
            self.size.append(k)
            # Runs with a number in a short notice: one of them at least must be there.
            plain = [x for x in text.split() if SOLID[np.frombuffer(x.encode(), np.uint8)].any()]
            number = np.array([any(c.isdigit() for c in x) for x in plain])
            self.dated.append(np.unique(runs[[number[a: a + k].any() for a in at.tolist()]]) if len(word) <= NAMED else runs[:0])
        self.tables = {}
        for k, lengths in kinds.items():
            self.tables[k] = {}
            for w, members in sorted(lengths.items()):
                bands = 1 if w == 1 else BANDS  # single runs: one register is equal or not
                lowest = np.stack([_registers(self.sets[t]).min(axis=1)[:bands] for t in members])
                self.tables[k][w] = [_lookup(lowest[:, b], np.array(members)) for b in range(bands)]
        #: For each template, what relatives of another name lack.
        self.apart: list[list[np.ndarray]] = []
        for t, own in enumerate(self.sets):
            self.apart.append([])
            for u, other in enumerate(self.sets):
                if self.name[u] != self.name[t] and self.size[u] == self.size[t]:
                    more = np.setdiff1d(own, other, assume_unique=True)
                    if 0 < len(more) <= len(own) / 2:
                        self.apart[t].append(more)

    def told(self, t: int, got: np.ndarray) -> bool:
        """Whether the runs ``got`` tell the template from its relatives and other versions."""
        if len(self.dated[t]) and not np.isin(self.dated[t], got).any():
            return False
        return all(2 * np.isin(more, got).sum() >= len(more) for more in self.apart[t])


def _lookup(value: np.ndarray, template: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((template, value))
    return value[order], template[order]


def retrieved(values: np.ndarray, tables: dict) -> Iterator[tuple[int, int, int]]:
    """(w, window, template) where a value agrees in a band; window i of size w begins at run i * w and has 2w runs."""
    low = (values & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    high = (values >> np.uint64(32)).astype(np.uint32)
    out: set[tuple[int, int, int]] = set()
    for band, factor in enumerate(_FACTORS):
        if not any(band < len(table) for table in tables.values()):
            break
        least, size = low * factor ^ high, 1
        for w, table in tables.items():  # in order of w: registers of a length are minima of those of half of it
            if band >= len(table):
                continue
            while size < w:
                if len(least) % 2:
                    least = np.r_[least, least[-1:]]
                least, size = np.minimum(least[::2], least[1::2]), 2 * size
            window = least
            if w > 1:
                window = least.copy()
                window[:-1] = np.minimum(least[:-1], least[1:])
            value, template = table[band]
            at = np.searchsorted(value, window)
            hit = np.flatnonzero(value[np.minimum(at, len(value) - 1)] == window)
            for i, j in zip(hit.tolist(), at[hit].tolist(), strict=True):
                same = value[j]
                while j < len(value) and value[j] == same:
                    out.add((w, i, int(template[j])))
                    j += 1
    yield from sorted(out)


def notices(texts: Texts, templates: Templates) -> Iterator[tuple[int, str, float, int, int]]:
    """Document, name, containment and words [start, end) of every notice found; of several for the same words, the one with most."""
    word, doc = plain_words(texts)
    first_word = np.searchsorted(doc, np.arange(texts.n))
    made: dict[int, tuple] = {}
    seen: dict[tuple[int, int], set[int]] = {}
    for k, tables in templates.tables.items():
        values, at = made[k] = shingles(word, doc, k)
        if not len(values):
            continue
        for w, window, t in retrieved(values, tables):
            low, high = max(0, (window - 1) * w), min(len(values), (window + 3) * w)
            own = templates.sets[t]
            place = np.minimum(np.searchsorted(own, values[low:high]), len(own) - 1)
            for i in (np.flatnonzero(own[place] == values[low:high]) + low).tolist():
                seen.setdefault((int(doc[at[i]]), t), set()).add(i)
    found: dict[int, list[tuple[int, float, int, np.ndarray]]] = {}
    for (d, t), hits in sorted(seen.items()):
        own, k = templates.sets[t], templates.size[t]
        values, at = made[k]
        i = np.array(sorted(hits))
        # Runs of one notice stand close together; a wide gap begins another.
        new = np.flatnonzero(np.r_[True, np.diff(at[i]) > len(own) + k])
        for a, b in zip(new.tolist(), np.r_[new[1:], len(i)].tolist(), strict=True):
            got = np.unique(values[i[a:b]])
            share = len(got) / len(own)
            if share >= LEAST and templates.told(t, got):
                words = np.unique(at[i[a:b]][:, None] + np.arange(k)) - first_word[d]
                found.setdefault(d, []).append((len(words), share, t, words))
    for d, several in sorted(found.items()):
        taken = np.zeros(0, np.int64)
        for n, share, t, words in sorted(several, key=lambda x: (-x[0], -x[1], x[2], x[3][0])):
            if 2 * np.isin(words, taken).sum() <= n:
                taken = np.union1d(taken, words)
                yield d, templates.name[t], share, int(words[0]), int(words[-1]) + 1


def scan(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """doc_id, licence, containment, word_start and word_end of every notice in every row."""
    if sum(len(t.encode()) for _, t in templates) > MAX_BYTES:
        raise ValueError("scan these templates in several calls")
    held = docs.sparkSession.sparkContext.broadcast(Templates(templates))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in chunks(batch.column(1)):
                rows = list(notices(texts, held.value))
                if rows:
                    d, name, share, start, end = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": batch.column(0).slice(texts.first, texts.n).take(pa.array(d)), "licence": pa.array(name), "containment": pa.array(share),
                        "word_start": pa.array(start, pa.int64()), "word_end": pa.array(end, pa.int64())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        find, "doc_id long, licence string, containment double, word_start long, word_end long")
