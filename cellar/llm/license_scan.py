"""License scan by conditional compression.

A candidate block is a run of neighbouring lines that mention licensing.  Each
block is compressed alone and with every template as a raw zstandard
dictionary; the templates are ranked by the bytes they save.  Of those that
save enough, in that order, the one whose wording stands in the block with the
fewest word differences, few enough and with no other version number, is
confirmed.

No rows move between tasks: a block is judged where its document is read, and
equal blocks of a task are judged once (a bounded cache), so a notice that a
third of all documents carry costs no shuffle.

Defined cases: null or empty texts have no blocks; a document without candidate
lines gives no rows; repeated rows give their blocks once a row; ties between
templates go to the smaller template name; a null doc_id is passed on; other
columns of the input are not read.
"""

from __future__ import annotations

import re
import sys

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.llm import common as c
from cellar.llm.registry import query

# The usual short notices of public licenses (name -> wording).
TEMPLATES = {
    "AGPL-3.0": "This program is licensed under the GNU Affero General Public License, version 3.",
    "All-rights-reserved": "All rights reserved.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following two conditions are met",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights under CC0 1.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Public-domain": "This work has been dedicated to the public domain.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
#: Lines that may hold a notice.
CANDIDATE = r"(?i)licen[sc]|copyright|all rights reserved|public domain|permission is hereby|redistribution and use|cc0|spdx"
#: Share of a template's words that may differ, and bytes it must save.
MAX_DIFFERENCE = 0.25
MIN_GAIN = 4
SCHEMA = ("doc_id long, first_line long, n_lines long, license string, confirmed boolean, gain int, "
          "alone int, n_words int, n_differences int, block string")


def wording(text: str) -> list[str]:
    """Lower-case words and numbers; punctuation and spacing do not count."""
    return re.findall(r"\d+(?:\.\d+)*|[^\W\d_]+", text.lower())


def differences(template: list[str], words: list[str]) -> tuple[int, int, int]:
    """(fewest word edits that turn some run of ``words`` into ``template``,
    start, end of that run): the leftmost run on a tie."""
    n = len(words)
    place = np.arange(n + 1)
    codes = {w: i for i, w in enumerate(dict.fromkeys(template))}
    text = np.array([codes.get(w, -1) for w in words] or [-1])[:n]
    cost, start = np.zeros(n + 1, np.int64), place.copy()
    for i, w in enumerate(template, 1):
        take = cost[:-1] + (text != codes[w])
        drop = cost + 1
        cur, frm = drop.copy(), start.copy()
        better = take <= drop[1:]
        cur[1:][better], frm[1:][better] = take[better], start[:-1][better]
        low = np.minimum.accumulate(cur - place)  # words of the text left out
        source = np.maximum.accumulate(np.where(cur - place == low, place, 0))
        cost, start = low + place, frm[source]
    end = int(np.argmin(cost))
    return int(cost[end]), int(start[end]), end


def _coders(names: tuple[tuple[str, str], ...]):
    """Made once per worker process and kept between tasks."""
    kept = vars(sys).setdefault("_cellar_coders", {})
    if names not in kept:
        if len(kept) > 3:
            kept.clear()
        kept[names] = _new_coders(names)
    return kept[names]


def _new_coders(names: tuple[tuple[str, str], ...]):
    make = lambda d: zstandard.ZstdCompressor(
        level=19, write_content_size=False, write_checksum=False, write_dict_id=False, **d)
    alone = make({})
    return alone, [(name, wording(text), make({"dict_data": zstandard.ZstdCompressionDict(
        " ".join(wording(text)).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)})) for name, text in names]


def judge(block: str, templates: dict[str, str] = TEMPLATES):
    """(license, confirmed, gain, bytes alone, words, differences) of a block;
    the best ranked template when none is confirmed, null when none saves bytes."""
    alone, coders = _coders(tuple(sorted(templates.items())))
    words = wording(block)
    text = " ".join(words).encode()
    size = len(alone.compress(text))
    ranked = sorted(((size - len(coder.compress(text)), name, tw) for name, tw, coder in coders),
                    key=lambda x: (-x[0], x[1]))
    numbers = lambda ws: [w for w in ws if w[0].isdigit()]
    first, best = None, None
    for gain, name, tw in ranked:
        if gain < MIN_GAIN:
            break
        n, start, end = differences(tw, words)
        ok = n <= MAX_DIFFERENCE * len(tw) and numbers(words[start:end]) == numbers(tw)
        if ok and (best is None or n < best[5]):
            best = (name, True, gain, size, len(words), n)
        first = first or (name, False, gain, size, len(words), n)
    return best or first or (None, False, 0, size, len(words), 0)


def blocks(text: str):
    """(first line, number of lines, block) of each run of candidate lines."""
    found = re.compile(CANDIDATE)
    run: list[str] = []
    lines = text.split("\n")
    for i, line in enumerate([*lines, ""]):
        if i < len(lines) and found.search(line):
            run.append(line)
        elif run:
            yield i - len(run), len(run), "\n".join(run)
            run = []


def _scan(batches):
    known: dict[str, tuple] = {}
    for batch in c.chunks(batches):
        rows = []
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            for first, n, block in blocks(text or ""):
                if block not in known:
                    if len(known) > 10_000:
                        known.clear()
                    known[block] = judge(block)
                rows.append((doc, first, n, *known[block], block))
        cols = list(zip(*rows)) if rows else [()] * 10
        kinds = [pa.int64()] * 3 + [pa.string(), pa.bool_()] + [pa.int32()] * 4 + [pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(cols, kinds)],
                                         names=[f.split()[0] for f in SCHEMA.split(", ")])


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row for each candidate block of each document."""
    return docs.select("doc_id", "text").where(F.col("text").rlike(CANDIDATE)).mapInArrow(_scan, SCHEMA)


@query("op3_license_scan")
def op3(spark, sf_dir):
    return scan_licenses(c.documents(spark, sf_dir))
