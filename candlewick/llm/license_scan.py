"""Licence scan: whole texts and their lines against licence templates.

Texts are normalised to words (runs of letters and digits, lower case).  Two
texts are compared by the Dice coefficient of their word bigrams, counted with
repeats: ``2 * common / (n + m)``.  As ``common`` is at most the smaller count,
a template of ``m`` bigrams can reach the threshold ``t`` only for counts
between ``m * t / (2 - t)`` and ``m * (2 - t) / t``; all other templates are
pruned by the count alone, before any bigram is made.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import prepared

_WORD = re.compile(r"[^\W_]+")

# Notices by which public licences are commonly declared.
LICENCE_TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met:"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("all-rights-reserved", "All rights reserved."),
)


def normalised(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def bigrams(words: Sequence[str]) -> Counter:
    return Counter(zip(words, words[1:]))


class Templates:
    """The templates by number of bigrams, with the bounds of a Dice threshold."""

    def __init__(self, templates: Sequence[tuple[str, str]], threshold: float):
        rows = sorted((len(w) - 1, name, number, bigrams(w)) for number, (name, text) in enumerate(templates)
                      for w in [normalised(text)] if len(w) > 1)
        self.rows, self.sizes, self.threshold = rows, [r[0] for r in rows], threshold

    def candidates(self, count: int) -> list[tuple]:
        t = self.threshold
        if not t:
            return self.rows
        low, high = count * t / (2 - t), count * (2 - t) / t
        return self.rows[bisect_left(self.sizes, low - 1e-9):bisect_right(self.sizes, high + 1e-9)]

    def matches(self, text: str) -> Iterator[tuple[float, str, int]]:
        """``(dice, licence, template)`` of every template that reaches the threshold."""
        words = normalised(text)
        found = self.candidates(len(words) - 1) if len(words) > 1 else []
        own = bigrams(words) if found else None
        for size, name, number, other in found:
            common = sum(min(n, own[b]) for b, n in other.items() if b in own)
            dice = 2.0 * common / (size + len(words) - 1)
            if common and dice >= self.threshold:
                yield dice, name, number


def scan_licences(docs: DataFrame, templates: Sequence[tuple[str, str]] = LICENCE_TEMPLATES, *, threshold: float = 0.8,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, licence, line, dice, template)``: every match of every row.

    Scanned are the whole text (``line`` -1) and, if it has several, each line
    (0-based).  Of several templates of one licence a unit reports the best, of
    equal ones the first; repeated lines report each time.  NULL, empty and
    one-word texts match nothing, rows without a match have no row here,
    repeated rows repeat their matches, other columns are not read.  The
    templates are a short list and go along with the tasks."""
    prepared(docs.sparkSession)
    names = ["doc_id", "licence", "line", "dice", "template"]

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(templates, threshold)
        for batch in stream:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                lines = text.split("\n")
                for at, unit in [(-1, text), *(enumerate(lines) if len(lines) > 1 else ())]:
                    best = {}
                    for dice, name, number in known.matches(unit):
                        if name not in best or (-dice, number) < (-best[name][0], best[name][1]):
                            best[name] = dice, number
                    rows += [(doc, name, at, dice, number) for name, (dice, number) in best.items()]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.int32(), pa.float64(),
                                                                 pa.int32()))], names)

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(batches, "doc_id long, licence string, line int, dice double, template int")


def best_licence(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, licence, line, dice, matches)`` for every distinct doc_id with a match:
    the highest Dice (ties: first line, then name) and the number of matches."""
    found = scan_licences(docs, **options)
    best = F.min(F.struct((-F.col("dice")).alias("d"), F.col("line"), F.col("licence")))
    return (found.groupBy("doc_id").agg(best.alias("b"), F.count("*").alias("matches"))
            .select("doc_id", F.col("b.licence").alias("licence"), F.col("b.line").alias("line"),
                    (-F.col("b.d")).alias("dice"), "matches"))
