"""License scans by patience alignment.

Words of text and template are compared in lower case without punctuation.  A text is
looked at where enough of a template's distinct words stand close together: a stretch
a quarter longer than the template.  There the two are aligned: words that are unique
in both are anchors, the longest increasing subsequence of anchors is kept, and the
gaps between kept anchors are aligned the same way.  A gap without anchors is matched
from both of its ends.  Coverage is the share of the template's words that are
matched.  Scanning goes on behind each match, so repeated notices are all found.

A map over whole texts, without a shuffle.  Templates are a parameter, broadcast with
the task; a text is aligned only if it has as many distinct words as the least coverage
needs at least (the commonest of the template first, as repeats count), so most texts
cost one hash lookup a word.

Edge cases: null and empty texts match nothing; a template without words matches
nothing; ties go to the template first in sort order, then the first place.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldvein.llm.hashing import blocks, words

LEAST = 0.8
SLACK = 1.25  # length of the stretch that is aligned, in template lengths

# Wordings of public licenses' notices.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at"
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met"
    ),
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "mit": "Released under the MIT License",
    "mit-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files, to deal in the Software without restriction"
    ),
}
_FOLD = np.full(256, 32, np.uint8)
_FOLD[128:] = np.arange(128, 256)
for _low, _high in ((48, 57), (65, 90), (97, 122)):
    _FOLD[_low : _high + 1] = np.arange(_low, _high + 1)


def increasing(values: list[int]) -> list[int]:
    """Places of a longest increasing subsequence, by piles."""
    tops: list[int] = []
    place: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        tops[k : k + 1], place[k : k + 1] = [v], [i]
        before[i] = place[k - 1] if k else -1
    out, i = [], place[-1] if place else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def align(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Matched places of a and b, in order, by patience."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        at = {b[j]: j for j in range(b0, b1) if in_b[b[j]] == 1}
        anchors = [(i, at[a[i]]) for i in range(a0, a1) if in_a[a[i]] == 1 and a[i] in at]
        kept = [anchors[k] for k in increasing([j for _, j in anchors])]
        if not kept:
            continue
        out += kept
        edges = [(a0 - 1, b0 - 1), *kept, (a1, b1)]
        todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:]) if i + 1 < k and j + 1 < m]
    return sorted(out)


def fewest(template: list[int], least: float) -> int:
    """The least number of distinct words by which the coverage can be reached; one without words needs 1."""
    total, used = 0, 0
    for n in sorted(Counter(template).values(), reverse=True):
        if total / len(template) >= least:
            break
        total, used = total + n, used + 1
    return max(1, used)


def scan(text: np.ndarray, template: list[int], least: float) -> list[tuple[float, int, int]]:
    """(coverage, first word, last word + 1) of each match in word numbers; -1 is another word."""
    need = fewest(template, least)
    wide = int(np.ceil(SLACK * len(template)))
    inside = np.isin(text, template)
    place = np.flatnonzero(inside)
    out: list[tuple[float, int, int]] = []

    def match(start: int, stop: int) -> tuple[float, int, int] | None:
        end = min(start + wide, stop)
        stretch = text[start:end]
        if len(set(stretch[inside[start:end]].tolist())) < need:
            return None
        pairs = align(template, stretch.tolist())
        coverage = len(pairs) / len(template)
        return (coverage, start + pairs[0][1], start + pairs[-1][1] + 1) if coverage >= least else None

    todo = [(0, len(text))]
    while todo:
        start, stop = todo.pop()
        p = int(np.searchsorted(place, start))
        while p < len(place) and place[p] < stop and (best := match(int(place[p]), stop)) is None:
            p += 1
        if p == len(place) or place[p] >= stop:
            continue
        begin = int(place[p])
        while (p := p + 1) < len(place) and place[p] < best[2]:
            other = match(int(place[p]), stop)
            if other and (other[0], other[1] - other[2]) > (best[0], best[1] - best[2]):
                best = other
        out.append(best)
        todo += [(best[2], stop), (begin, best[1])]
    return sorted(out, key=lambda m: m[1])


def find_licenses(
    docs: DataFrame,
    templates: Mapping[str, str] | None = None,
    id: str = "doc_id",
    text: str = "text",
    least: float = LEAST,
) -> DataFrame:
    """(id, matches) for each row; matches: license, coverage, from_word, to_word, the best first.

    Word numbers count the words that are left when punctuation is taken as space.
    """
    named = sorted((templates if templates is not None else TEMPLATES).items())
    known: dict[int, int] = {}
    numbered: list[tuple[str, list[int]]] = []
    for name, own in named:
        data = _FOLD[np.frombuffer(own.encode(), np.uint8)]
        hashes = words(data, np.array([0, len(data)]), lower=True).hashes().tolist()
        numbered.append((name, [known.setdefault(h, len(known)) for h in hashes]))
    vocabulary = np.array(sorted(known), np.uint64)
    number = np.array([known[h] for h in sorted(known)], np.int64)
    member = np.zeros((max(1, len(known)), len(numbered)), np.float32)
    for t, (_, own) in enumerate(numbered):
        member[own, t] = 1
    need = np.array([fewest(own, least) for _, own in numbered])
    schema = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("from_word", pa.int32()), ("to_word", pa.int32())]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[dict]] = [[] for _ in range(len(batch))]
            for row, data, offsets in blocks(batch.column(1)) if len(vocabulary) else ():
                w = words(_FOLD[data], offsets, lower=True)
                h = w.hashes()
                at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
                code = np.where(vocabulary[at] == h, number[at], -1)
                has = np.zeros((len(offsets) - 1, len(known)), np.float32)
                hit = code >= 0
                has[w.texts()[hit], code[hit]] = 1
                for d, t in zip(*np.nonzero(has @ member >= need)):
                    found = scan(code[w.first[d] : w.first[d + 1]], numbered[t][1], least)
                    out[row + d] += [{"license": numbered[t][0], "coverage": c, "from_word": a, "to_word": b} for c, a, b in found]
            for found in out:
                found.sort(key=lambda m: (-m["coverage"], m["license"], m["from_word"]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, schema)], ["id", "matches"])

    kind = dict(docs.dtypes)[id]
    found = docs.select(id, text).mapInArrow(task, f"id {kind}, matches array<struct<license:string,coverage:double,from_word:int,to_word:int>>")
    return found.select(F.col("id").alias(id), "matches")
