r"""License scans by conditional compression (operator 3).

Candidate blocks are runs of words around licence cues, ``REACH`` words to either side (found on the JVM,
so only documents with a cue reach Python); lines play no part, so a notice may be
wrapped in any way.  A block is compressed by zstandard alone and with each template as raw
dictionary; templates are tried in the order of the share of bytes that their dictionary saves, and the
first one confirmed by wording is the licence.  Wording: the least number of word edits (words missing,
added or changed) between the template and any stretch of the block, found exactly by dynamic
programming and listed; at most ``MAX_EDIT_SHARE`` of the template's words.  Words that
tell licences apart (numbers, and names such as ``by-nc``) are never edited, so a near
miss does not hide the licence itself.  Templates whose words cannot occur in the block with so few
edits (``places``, an exact bound) are not tried; no other is left out before one is confirmed.

A block may hold several licences: after one is confirmed its stretch is taken out and the
rest of the block is scanned again.

Defined results: null and empty texts have no block; very long texts are read whole; equal ranks are
ordered by template name; repeated rows are reported each; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbis.llm.common import doc_view, ship

ship(__name__)

# words of a cue may lie on two lines
CUE_WORDS = (r"(?i)licen[cs]e|copyright|copyleft|spdx|warrant|permission\s+(?:is|to)|redistribut|"
             r"public\s+domain|creative\s+commons|\bCC[\s-]*(?:BY|0)")
CUE = re.compile(CUE_WORDS)
WORD = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")
NEVER = 1 << 30               # cost of an edit of a telling word
STEP = 4096                   # words judged at a time; steps overlap by the longest occurrence
MAX_EDIT_SHARE = 0.2
LEVEL = 6

# fixed values: public licence notices, (licence, wording)
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files (the \"Software\"), to deal in the Software "
            "without restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
            "to whom the Software is furnished to do so, subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
                   "file except in compliance with the License. You may obtain a copy of the License at"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of "
                "the GNU General Public License as published by the Free Software Foundation, either "
                "version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of "
                "the GNU General Public License as published by the Free Software Foundation; either "
                "version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms "
                 "of the GNU Lesser General Public License as published by the Free Software Foundation; "
                 "either version 2.1 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are "
            "permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
            "without fee is hereby granted, provided that the above copyright notice and this "
            "permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
                     "International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
                     "International License."),
]
#: words that must agree: a number, or a name that tells one licence from another
TELLING = re.compile(r"\d|^(?:mit|apache|gnu|lesser|affero|mozilla|bsd|isc|cc0?|by(?:-\w+)*|"
                     r"attribution(?:-\w+)*|\w+-clause)$")
SCHEMA = ("line_from long, line_to long, license string, template string, saved double, n_edits long, "
          "edits array<string>")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def places(template: list[str], most: int, at: dict[str, list[int]]) -> list[tuple[int, int]]:
    """Stretches that hold every occurrence of ``template`` with at most ``most`` edits, given
    the positions of the block's words: it has at most len + most words, and at least
    len - most of them are the template's."""
    need, width = len(template) - most, len(template) + most
    hits = sorted(j for w in set(template) for j in at.get(w, ()))
    out = []
    for a, b in zip(hits, hits[need - 1:]):
        if b - a < width:
            lo = max(b - width + 1, 0)
            if out and lo <= out[-1][1]:
                lo = out.pop()[0]
            out.append((lo, a + width))
    return out


def edits(template: list[str], block: list[str]) -> tuple[int, int, int, list[str]]:
    """Least word edits between ``template`` and any stretch of ``block``, none of a telling
    word: (edits, first word, one past the last word, the edits as ``-missing`` / ``+added``);
    ``NEVER`` or more edits where there is no such stretch."""
    ids = {w: i for i, w in enumerate(template)}
    codes = np.fromiter((ids.get(w, -1) for w in block), np.int64, len(block))
    costs = [np.array([NEVER if TELLING.search(w) else 1 for w in x], np.int64) for x in (template, block)]
    added = np.concatenate([[0], costs[1].cumsum()])
    rows = np.zeros((len(template) + 1, len(block) + 1), np.int64)
    for i, w in enumerate(template, 1):
        change = np.where(codes == ids[w], 0, np.maximum(costs[0][i - 1], costs[1]))
        row = rows[i - 1] + costs[0][i - 1]
        np.minimum(row[1:], rows[i - 1, :-1] + change, out=row[1:])
        rows[i] = np.minimum.accumulate(row - added) + added
    end = int(rows[-1].argmin())
    if rows[-1, end] >= NEVER:
        return int(rows[-1, end]), 0, 0, []
    i, j, told = len(template), end, []
    while i:
        here = rows[i, j]
        if j and template[i - 1] == block[j - 1] and here == rows[i - 1, j - 1]:
            i, j = i - 1, j - 1
        elif j and template[i - 1] != block[j - 1] and \
                here == rows[i - 1, j - 1] + max(costs[0][i - 1], costs[1][j - 1]):
            told += [f"+{block[j - 1]}", f"-{template[i - 1]}"]
            i, j = i - 1, j - 1
        elif here == rows[i - 1, j] + costs[0][i - 1]:
            told.append(f"-{template[i - 1]}")
            i -= 1
        else:
            told.append(f"+{block[j - 1]}")
            j -= 1
    return int(rows[-1, end]), j, end, told[::-1]


class Compressors:
    """zstandard with nothing and with each template as raw dictionary."""

    def __init__(self):
        import zstandard as z
        p = z.ZstdCompressionParameters.from_level(LEVEL, write_content_size=False,
                                                   write_checksum=False, write_dict_id=False)
        self.alone = z.ZstdCompressor(compression_params=p)
        self.given = [z.ZstdCompressor(compression_params=p, dict_data=z.ZstdCompressionDict(
            self.fold(t).encode(), dict_type=z.DICT_TYPE_RAWCONTENT)) for _, t in TEMPLATES]
        self.words = [words_of(t) for _, t in TEMPLATES]
        self.most = [int(MAX_EDIT_SHARE * len(w)) for w in self.words]
        self.telling = [{x for x in w if TELLING.search(x)} for w in self.words]

    @staticmethod
    def fold(text: str) -> str:
        return " ".join(words_of(text))

    def ranked(self, block: str, which: list[int]) -> list[tuple[float, int]]:
        """(share of the compressed size that the template saves, template) of the templates
        ``which``, best first."""
        raw = self.fold(block).encode()
        alone = len(self.alone.compress(raw))
        saved = [((alone - len(self.given[k].compress(raw))) / alone, k) for k in which]
        return sorted(saved, key=lambda x: (-x[0], TEMPLATES[x[1]][0], x[1]))


#: words before and after a cue that belong to its block: a notice with all its edits
REACH = max(len(words_of(t)) + int(MAX_EDIT_SHARE * len(words_of(t))) for _, t in TEMPLATES)


def blocks(text: str) -> Iterator[tuple[list[str], list[int]]]:
    """(words, line of each word) of the runs of words around cues, counted in words alone:
    however a notice is wrapped, all of it lies within ``REACH`` words of each of its cues."""
    cues = [m.start() for m in CUE.finditer(text)]
    if not cues:
        return
    # lower-casing may change the length of a text, so words are found in the text as it is
    found = [(m.start(), m.group().lower()) for m in re.finditer(WORD.pattern, text, re.I | re.A)]
    starts = np.fromiter((at for at, _ in found), np.int64, len(found))
    ends = np.flatnonzero(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) == ord("\n"))
    near = np.searchsorted(starts, cues, side="right")
    lo = np.maximum(near - 1 - REACH, 0)
    hi = np.minimum(near + REACH, len(found))
    first = np.flatnonzero(np.r_[True, lo[1:] > hi[:-1]])        # cues whose reaches do not meet
    last = np.r_[first[1:], len(lo)] - 1
    for a, b in zip(lo[first].tolist(), hi[last].tolist()):
        if a < b:
            yield [w for _, w in found[a:b]], np.searchsorted(ends, starts[a:b]).tolist()


def scan_words(words: list[str], z: Compressors) -> list[tuple]:
    """(first word, last word, licence, template, saved, edits, list of edits) of each
    confirmed licence.  Templates are tried in the order of what they save the compressor; the first
    one whose wording differences are few enough, and none of a telling word, is the licence.  Those
    behind it are tried only if none before is confirmed, so nothing is lost by the order."""
    out = []
    todo = [(0, words)]
    while todo:
        base, words = todo.pop()
        if not words:
            continue
        at = defaultdict(list)
        for j, w in enumerate(words):
            at[w].append(j)
        # a telling word that the block lacks would be an edit
        able = {k: found for k, t in enumerate(z.words) if z.telling[k] <= at.keys()
                and (found := places(t, z.most[k], at))}
        for saved, k in z.ranked(" ".join(words), list(able)) if able else ():
            size, best = len(z.words[k]), None
            for start, stop in ((c, min(c + STEP + size + z.most[k], hi))
                                for lo, hi in able[k] for c in range(lo, hi, STEP)):
                n, lo, hi, told = edits(z.words[k], words[start:stop])
                if n <= z.most[k] and (best is None or (n, start + lo) < best[:2]):
                    best = (n, start + lo, start + hi, told)
            if best is not None:
                n, lo, hi, told = best
                out.append((base + lo, base + hi - 1, *TEMPLATES[k], saved, n, told))
                todo += [(base, words[:lo]), (base + hi, words[hi:])]
                break
    return sorted(out, key=lambda x: x[0])


def scan_block(block: str, z: Compressors) -> list[tuple]:
    """``scan_words`` of all words of a text."""
    return scan_words(words_of(block), z)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    z = Compressors()
    names = ["doc_id", *[f.split()[0] for f in SCHEMA.split(", ")]]
    for b in batches:
        own, rows = [], []
        for i, t in enumerate(b.column(1)):
            for words, line_of in blocks(t.as_py()):
                for lo, hi, *found in scan_words(words, z):
                    own.append(i)
                    rows.append((line_of[lo], line_of[hi], *found))
        cols = list(zip(*rows)) if rows else [[]] * 7
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.int64(),
                 pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(pa.array(own, pa.int64())),
             *[pa.array(list(c), t) for c, t in zip(cols, types)]], names=names)


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per confirmed licence: doc_id, line_from and line_to (of its first and last
    word, from 0), license, template, saved, n_edits, edits."""
    view = doc_view(docs, id_col, text_col).where(F.col("text").rlike(CUE_WORDS))
    return view.mapInArrow(_scan, f"doc_id {dict(view.dtypes)['doc_id']}, {SCHEMA}")
