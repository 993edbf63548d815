"""License scans: a generalised suffix automaton of licence texts streams over documents.

For each word the automaton gives the longest run of words ending there that some template holds. Long runs are laid
against the templates and chained into spans; a template that a chain covers well enough labels the document.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator, Mapping, Sequence
from importlib import resources

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W

PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Openings and terms of common licences, as their authors publish them.
TEMPLATES: list[tuple[str, str]] = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
]

#: Whole licences, as their authors publish them: files of this package, by label.
WHOLE = {"apache": ["Apache-2.0"], "artistic": ["Artistic"], "bsd": ["BSD"], "cc0": ["CC0-1.0"], "gpl": ["GPL-2", "GPL-3"], "lgpl": ["LGPL-2.1", "LGPL-3"], "mpl": ["MPL-2.0"]}


def whole_licenses() -> list[tuple[str, str]]:
    folder = resources.files(__package__) / "licence_texts"
    return [(label, (folder / f"{name}.txt").read_text("utf-8")) for label, names in WHOLE.items() for name in names]


#: Words that a run must have to be laid against a template, and words that a chain may skip on either side.
MIN_RUN = 3
MAX_GAP = 6
#: Share of a template's words that its chain must cover.
COVERAGE = 0.75


def template_words(text: str) -> list[str]:
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))


class SuffixAutomaton:
    """All runs of several word sequences; each state knows at which ends its longest run stands in them."""

    def __init__(self, sequences: Sequence[Sequence[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: dict[int, set[tuple[int, int]]] = {}
        for t, seq in enumerate(sequences):
            last = 0
            for i, w in enumerate(seq):
                last = self._extend(last, w)
                ends.setdefault(last, set()).add((t, i + 1))
        for v in sorted(range(1, len(self.next)), key=lambda v: -self.length[v]):
            if self.link[v] > 0:
                ends.setdefault(self.link[v], set()).update(ends.get(v, ()))
        self.ends = [sorted(ends.get(v, ())) for v in range(len(self.next))]
        self.sequences = sequences

    def _clone(self, p: int, q: int, w: int) -> int:
        c = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = c
            p = self.link[p]
        self.link[q] = c
        return c

    def _extend(self, last: int, w: int) -> int:
        if (q := self.next[last].get(w)) is not None:
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, q, w)
        v, p = len(self.next), last
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = v
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[v] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, w)
        return v

    def stream(self, codes: Sequence[int]) -> Iterator[tuple[int, int, int]]:
        """(end, length, state) of each maximal match: those that the next word does not lengthen."""
        v = length = 0
        for i, w in enumerate(codes):
            grown = self.next[v].get(w)
            if grown is None and length:
                yield i, length, v
            while grown is None and v:
                v = self.link[v]
                length = self.length[v]
                grown = self.next[v].get(w)
            if grown is None:
                v = length = 0
            else:
                v, length = grown, length + 1
        if length:
            yield len(codes), length, v


    def holders(self, least: int) -> list[list[tuple[int, int, int, int | None]]]:
        """For each state (sequence, end, length, next word): where its run, or a shorter end of it of least words or more, stands.

        Length is 0 for the run itself, else that of the longest end of it that stands there.
        """
        out: list[list[tuple[int, int, int, int | None]]] = [[] for _ in self.next]
        for v in sorted(range(1, len(self.next)), key=lambda v: self.length[v]):
            own, p = set(self.ends[v]), self.link[v]
            out[v] = [(t, e, 0, self.sequences[t][e] if e < len(self.sequences[t]) else None) for t, e in self.ends[v]]
            if self.length[p] >= least:
                out[v] += [(t, e, n or self.length[p], w) for t, e, n, w in out[p] if (t, e) not in own]
        return out

    def matches(self, codes: Sequence[int], least: int, holders: list[list[tuple[int, int, int, int | None]]]) -> Iterator[tuple[int, int, int, int]]:
        """(sequence, place, place in the sequence, length) of common runs of least words or more that the next word does not lengthen."""
        v = length = 0
        for i in range(len(codes) + 1):
            w = codes[i] if i < len(codes) else -1
            if length >= least:
                for t, e, n, after in holders[v]:
                    if after != w and (n or length) >= least:
                        yield t, i - (n or length), e - (n or length), n or length
            grown = self.next[v].get(w)
            while grown is None and v:
                v = self.link[v]
                length = self.length[v]
                grown = self.next[v].get(w)
            v, length = (0, 0) if grown is None else (grown, length + 1)


class Scanner:
    def __init__(self, templates: Sequence[tuple[str, str]] = TEMPLATES, phrases: Mapping[str, str] = PHRASES):
        own = [template_words(t) for _, t in templates]
        self.names = sorted({w for seq in own for w in seq} | {w for p in phrases for w in p.split()})
        number = {w: i for i, w in enumerate(self.names)}
        self.labels, self.sizes = [x for x, _ in templates], [len(s) for s in own]
        self.automaton = SuffixAutomaton([[number[w] for w in s] for s in own])
        self.holders = self.automaton.holders(MIN_RUN)
        self.phrases = [([number[w] for w in p.split()], label) for p, label in phrases.items()]
        self.known = pa.array([w.encode() for w in self.names], pa.large_binary())

    def spans(self, runs: list[tuple[int, list[int]]]) -> list[tuple[str, int, int, float]]:
        """(label, first word, end word, coverage) of each chain that covers its template, from (place, codes) runs of a text."""
        laid: dict[int, list[tuple[int, int, int]]] = {}
        for place, codes in runs:
            for t, at, own, length in self.automaton.matches(codes, MIN_RUN, self.holders):
                laid.setdefault(t, []).append((place + at, own, length))
        out = []
        for t, found in sorted(laid.items()):
            if sum(n for _, _, n in found) < COVERAGE * self.sizes[t]:
                continue
            out += [(self.labels[t], first, end, covered / self.sizes[t]) for first, end, covered in self._chains(sorted(found), COVERAGE * self.sizes[t])]
        return out

    @staticmethod
    def _chains(found: list[tuple[int, int, int]], least: float) -> list[tuple[int, int, int]]:
        """(first word, end word, covered) of the chains that cover least template words or more, without common words.

        A chain is of matches in order, each at most MAX_GAP words after the one before it. Chains that cover more come
        first; what lies between those taken is searched again, in case better ones held parts of it.
        """
        out, todo = [], [found]
        while todo:
            found = todo.pop()
            reach = max(n for _, _, n in found) + MAX_GAP
            best: list[tuple[int, int]] = []  # covered, first word
            for k, (d, s, n) in enumerate(found):
                covered, first = n, d
                for j in range(k - 1, -1, -1):
                    pd, ps, pn = found[j]
                    if d - pd > reach:
                        break
                    lap = max(0, pd + pn - d, ps + pn - s)  # words that both hold
                    if pd < d and ps < s and lap < n and d - pd - pn <= MAX_GAP and s - ps - pn <= MAX_GAP and best[j][0] + n - lap > covered:
                        covered, first = best[j][0] + n - lap, best[j][1]
                best.append((covered, first))
            taken: list[tuple[int, int, int]] = []
            passed = False
            for k in sorted((k for k, (covered, _) in enumerate(best) if covered >= least), key=lambda k: (-best[k][0], k)):
                (covered, first), end = best[k], found[k][0] + found[k][2]
                at = bisect_right(taken, (first, end, covered))
                if (at and taken[at - 1][1] > first) or (at < len(taken) and taken[at][0] < end):
                    passed = True
                else:
                    taken.insert(at, (first, end, covered))
            out += taken
            if passed:
                ends = [end for _, end, _ in taken]
                between: dict[int, list[tuple[int, int, int]]] = {}
                for d, s, n in found:
                    i = bisect_right(ends, d)
                    while i <= len(taken) and (ends[i - 1] if i else -1) < d + n:
                        a = max(d, ends[i - 1]) if i else d
                        b = min(d + n, taken[i][0]) if i < len(taken) else d + n
                        if b - a >= MIN_RUN:
                            between.setdefault(i, []).append((a, s + a - d, b - a))
                        i += 1
                todo += [sorted(x) for x in between.values()]
        return sorted(out)

    def scan(self, texts: pa.Array) -> list[dict]:
        w = W.split_words(texts, lower=True, classes=W.ALNUM)
        number = pc.fill_null(pc.index_in(w.vocab, self.known), -1).to_numpy(zero_copy_only=False).astype(np.int32)
        ids = number[w.codes] if len(w.codes) else np.zeros(0, np.int32)
        counts = w.counts()
        doc = np.repeat(np.arange(w.n_docs), counts)
        out = [{"n_words": n, "n_base": 0, "first_word": None, "last_word": None, "base": set(), "spans": []} for n in counts.tolist()]
        for phrase, label in self.phrases:
            k = len(phrase)
            if len(ids) < k:
                continue
            here = doc[: len(ids) - k + 1] == doc[k - 1 :]
            for i, p in enumerate(phrase):
                here &= ids[i : len(ids) - k + 1 + i] == p
            for at in np.flatnonzero(here).tolist():
                o, place = out[doc[at]], at - int(w.doc_start[doc[at]])
                o["n_base"] += 1
                o["base"].add(label)
                o["first_word"] = place if o["first_word"] is None else min(place, o["first_word"])
                o["last_word"] = place if o["last_word"] is None else max(place, o["last_word"])
        hit = ids >= 0
        edge = np.ones(len(ids) + 1, bool)
        edge[1:-1] = (hit[1:] != hit[:-1]) | (doc[1:] != doc[:-1])
        bounds = np.flatnonzero(edge)
        if not len(ids):
            return out
        a, b = bounds[:-1], bounds[1:]
        take = hit[a] & (b - a >= MIN_RUN)
        runs: dict[int, list[tuple[int, list[int]]]] = {}
        for i, j in zip(a[take].tolist(), b[take].tolist()):
            d = int(doc[i])
            runs.setdefault(d, []).append((i - int(w.doc_start[d]), ids[i:j].tolist()))
        for d, found in runs.items():
            out[d]["spans"] = self.spans(found)
        return out


SPAN = T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("first", T.LongType()), T.StructField("end", T.LongType()), T.StructField("coverage", T.DoubleType())]))


def scan_licenses(df: DataFrame, text: str = "text", id_col: str = "doc_id", templates: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """id_col, n_words, n_base, first_word, last_word, base_labels, labels, score and spans of each text.

    Base labels come from phrases, others from templates that a chain of long matches covers; score is the largest
    coverage. Each place that covers a template is a span. Templates are (label, text) pairs, those of TEMPLATES and the
    whole licences unless others are given. Null and empty texts have no words and labels and score 0; texts are read whole; of
    equal chains that share words the first stays; repeated rows repeat; an empty table gives no rows; other columns are not read. The automaton has at most
    two states a template word, so what tasks get is bounded by the templates.
    """
    source = W.lean(df).select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text}`").cast("string").alias("__text"))
    schema = T.StructType([T.StructField(id_col, source.schema["__id"].dataType), *[T.StructField(c, T.LongType()) for c in ("n_words", "n_base", "first_word", "last_word")], T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("spans", SPAN)])
    arrow_span = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64()), ("coverage", pa.float64())]))

    chosen = [*TEMPLATES, *whole_licenses()] if templates is None else list(templates)
    key = ("licenses", hash(tuple(chosen)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = W.kept(key, lambda: Scanner(chosen))
        for b in W.slices(batches, "__text", key=key):
            found = scanner.scan(b.column("__text"))
            longs = [pa.array([o[c] for o in found], pa.int64()) for c in ("n_words", "n_base", "first_word", "last_word")]
            labels = [",".join(sorted(o["base"] | {s[0] for s in o["spans"]})) for o in found]
            spans = pa.array([[dict(zip(("label", "first", "end", "coverage"), s)) for s in o["spans"]] for o in found], arrow_span)
            yield pa.RecordBatch.from_arrays([b.column("__id"), *longs, pa.array([",".join(sorted(o["base"])) for o in found]), pa.array(labels), pa.array([max((s[3] for s in o["spans"]), default=0.0) for o in found]), spans], names=schema.names)

    return source.mapInArrow(run, schema)
