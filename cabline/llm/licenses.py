"""License scans: exact set-similarity join of text blocks with license templates.

A template is a license notice, short or a whole paragraph; a block is any stretch of a text,
over line breaks, of at most ``slack`` times the template's words. A template is found where
the distinct words of a block hold at least its ``need``: the threshold's share of its own.

The words of all templates are ordered by how often they stand in all texts, rarest first.
Three filters leave few stretches to count, and lose none:

* prefix: a block that reaches the need holds one of the template's first |T| - need + 1
  words in that order, so only the surroundings of such a word are looked at;
* length: the surroundings must have as many words as needed;
* position: if the word is the rarest that block and template share, all others are more
  frequent, and enough such words must stand around it (at most the template's own rest).

What passes is counted exactly in a sliding stretch. All that is found is reported; where a
template with more words overlaps a place, the place is marked as not specific. Templates
are a small parameter and travel to the tasks; the texts stay where they are.

Besides, phrases are looked for wherever their words stand one after another.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabline.llm import common as C

#: Words: runs of ASCII letters and digits and of anything beyond ASCII.
WORD = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = re.compile(WORD)

#: Phrases and their labels (fixed by the contract).
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

#: Short license notices and the labels that the similarity join gives.
TEMPLATES = (
    ("released under the MIT license", "mit"),
    ("licensed under the MIT license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under the Apache license version 2.0", "apache-2.0"),
    ("you may not use this file except in compliance with the license", "apache-2.0"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("licensed under the BSD 3 clause license", "bsd"),
    ("this work is licensed under the GNU general public license version 2", "gpl-2.0"),
    ("this work is licensed under the GNU general public license version 3", "gpl-3.0"),
    ("licensed under the GNU lesser general public license version 3", "lgpl-3.0"),
    ("licensed under the GNU affero general public license version 3", "agpl-3.0"),
    ("this source code form is subject to the terms of the Mozilla public license", "mpl-2.0"),
    ("licensed under CC BY 4.0", "cc-by-4.0"),
    ("licensed under CC BY SA 4.0", "cc-by-sa-4.0"),
    ("licensed under CC BY NC 4.0", "cc-by-nc-4.0"),
    ("licensed under CC BY ND 4.0", "cc-by-nd-4.0"),
    ("this work is licensed under a creative commons attribution license", "cc-by"),
    ("this is free and unencumbered software released into the public domain", "public-domain"),
)

#: License paragraphs, of which some words may differ.
NOTICES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions", "mit"),
    ("licensed under the Apache license version 2.0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2.0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied", "apache-2.0"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "isc"),
    ("this program is free software you can redistribute it and or modify it under the terms of the GNU general public license as published by the free software foundation either version 2 of the license or at your option any later version", "gpl-2.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the GNU general public license as published by the free software foundation either version 3 of the license or at your option any later version", "gpl-3.0"),
    ("this library is free software you can redistribute it and or modify it under the terms of the GNU lesser general public license as published by the free software foundation either version 2.1 of the license or at your option any later version", "lgpl-2.1"),
    ("this program is free software you can redistribute it and or modify it under the terms of the GNU affero general public license as published by the free software foundation either version 3 of the license or at your option any later version", "agpl-3.0"),
    ("this source code form is subject to the terms of the Mozilla public license v 2.0 if a copy of the MPL was not distributed with this file you can obtain one at http mozilla org MPL 2.0", "mpl-2.0"),
    ("this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means", "public-domain"),
)


@dataclass(frozen=True)
class LicenseParams:
    """threshold, notice_threshold: share of the distinct words of a template (short notice)
    and of a notice (license paragraph) that a block must hold. templates, notices: (text,
    label) pairs, bounded lists. phrases: (words, label) pairs. slack: length of a block in
    times a template's."""

    threshold: float = 0.95
    templates: tuple[tuple[str, str], ...] = TEMPLATES
    phrases: tuple[tuple[str, str], ...] = PHRASES
    notices: tuple[tuple[str, str], ...] = NOTICES
    notice_threshold: float = 0.8
    slack: float = 1.25

    def all_templates(self) -> list[tuple[str, str, float]]:
        """(text, label, threshold) of the templates, then of the notices."""
        return [(t, label, self.threshold) for t, label in self.templates] + [(t, label, self.notice_threshold) for t, label in self.notices]


def words_of(text: str) -> list[bytes]:
    """Words of a text with A-Z lowered (other letters as they are)."""
    return _WORD.findall(text.encode().lower())


def need(size: int, threshold: float) -> int:
    return ceil(size * threshold - 1e-9)


class Index:
    """Templates by the words of their prefixes under one global order of words. ``seen``
    counts what became of prefix words met in texts."""

    def __init__(self, p: LicenseParams, counts: dict[bytes, int]) -> None:
        every = p.all_templates()
        self.labels = [label for _, label, _ in every]
        self.sets = [frozenset(words_of(t)) for t, _, _ in every]
        self.needs = [max(1, need(len(s), share)) for s, (_, _, share) in zip(self.sets, every)]
        self.spans = [ceil(len(words_of(t)) * p.slack) for t, _, _ in every]
        order = sorted({w for s in self.sets for w in s}, key=lambda w: (counts.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(order)}
        self.prefix: dict[bytes, list[tuple[int, int]]] = {}
        for k, (s, least) in enumerate(zip(self.sets, self.needs)):
            for place, w in enumerate(sorted(s, key=self.rank.__getitem__)[: len(s) - least + 1]):
                self.prefix.setdefault(w, []).append((k, place))
        self.keys = frozenset(self.prefix)
        self.seen = {"prefix": 0, "length": 0, "position": 0, "counted": 0, "found": 0}

    def surroundings(self, words: list[bytes]) -> dict[int, list[list[int]]]:
        """For each template the stretches of the text that the filters leave, merged."""
        out: dict[int, list[list[int]]] = {}
        ranks = None
        for i, w in enumerate(words):
            for k, place in self.prefix.get(w, ()):
                self.seen["prefix"] += 1
                least, span = self.needs[k], self.spans[k]
                a, b = max(0, i - span + 1), min(len(words), i + span)
                if b - a < least:
                    self.seen["length"] += 1
                    continue
                if ranks is None:
                    ranks = [self.rank.get(x, -1) for x in words]
                above = len({r for r in ranks[a:b] if r > ranks[i]})
                if 1 + min(above, len(self.sets[k]) - place - 1) < least:
                    self.seen["position"] += 1
                    continue
                mine = out.setdefault(k, [])
                if mine and a <= mine[-1][1]:
                    mine[-1][1] = max(b, mine[-1][1])
                else:
                    mine.append([a, b])
        return out

    def places(self, k: int, words: list[bytes], start: int, end: int) -> list[list[int]]:
        """[first word, last word, most shared words] of the blocks in words[start:end] that
        hold template k; blocks that overlap are one place."""
        wanted, span, least = self.sets[k], self.spans[k], self.needs[k]
        at = [i for i in range(start, end) if words[i] in wanted]
        count: dict[bytes, int] = {}
        out, lo = [], 0
        for last in at:
            count[words[last]] = count.get(words[last], 0) + 1
            # out of reach, or there again further on
            while last - at[lo] >= span or count[words[at[lo]]] > 1:
                w = words[at[lo]]
                count[w] -= 1
                if not count[w]:
                    del count[w]
                lo += 1
            if len(count) >= least:
                if out and at[lo] <= out[-1][1]:
                    out[-1][1:] = [last, max(out[-1][2], len(count))]
                else:
                    out.append([at[lo], last, len(count)])
        return out

    def find(self, words: list[bytes]) -> list[dict]:
        found = []
        for k, spans in self.surroundings(words).items():
            self.seen["counted"] += len(spans)
            found += [(k, *x) for a, b in spans for x in self.places(k, words, a, b)]
        self.seen["found"] += len(found)
        found.sort(key=lambda x: (x[1], x[0]))
        wider = lambda k, a, b: any(self.sets[k] < self.sets[j] and x <= b and a <= y for j, x, y, _ in found)
        return [{"first": a, "last": b, "template": k, "label": self.labels[k], "share": n / len(self.sets[k]), "specific": not wider(k, a, b)}
                for k, a, b, n in found]


def _count(vocabulary: frozenset[bytes]):
    """Occurrences of template words in a task's texts."""

    def run(batches):
        total: dict[bytes, int] = {}
        for batch in batches:
            raw, off = C.text_buffers(batch.column("text"))
            for a, b in C.slices(off):
                words = [w for x, y in zip(off[a:b], off[a + 1: b + 1]) for w in _WORD.findall(raw[x:y].tobytes().lower())]
                for w in filter(vocabulary.__contains__, words):
                    total[w] = total.get(w, 0) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.decode() for w in total], pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    return run


SCANNED = ("n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, score double, "
           "matches array<struct<first: long, last: long, template: int, label: string, share: double, specific: boolean>>")


def _scan(p: LicenseParams, counts: dict[bytes, int]):
    phrases = [(words_of(t), label) for t, label in p.phrases]
    match_type = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("template", pa.int32()), ("label", pa.string()),
                                     ("share", pa.float64()), ("specific", pa.bool_())]))

    def one(index: Index, text: bytes):
        words = _WORD.findall(text)
        have = set(words)
        starts, base = [], set()
        for seq, label in phrases:
            if not have.issuperset(seq):
                continue
            i = -1
            while True:
                try:
                    i = words.index(seq[0], i + 1)
                except ValueError:
                    break
                if words[i: i + len(seq)] == seq:
                    starts.append(i)
                    base.add(label)
        matches = index.find(words) if not have.isdisjoint(index.keys) else []
        score = 1.0 if base else max((m["share"] for m in matches), default=0.0)
        labels = base | {m["label"] for m in matches}
        return (len(words), len(starts), min(starts, default=None), max(starts, default=None), sorted(base), sorted(labels), score, matches)

    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.float64(), match_type]
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"]

    def run(batches):
        index = Index(p, counts)
        for batch in batches:
            raw, off = C.text_buffers(batch.column("text"))
            for a, b in C.slices(off):
                data = raw[off[a]: off[b]].tobytes().lower()
                cut = (off[a: b + 1] - off[a]).tolist()
                rows = [one(index, data[x:y]) for x, y in zip(cut[:-1], cut[1:])]
                cols = list(zip(*rows)) if rows else [[] for _ in types]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(a, b - a), *(pa.array(list(c), t) for c, t in zip(cols, types))], names=["row", *names])

    return run


def word_counts(docs: DataFrame, p: LicenseParams) -> dict[bytes, int]:
    """How often each template word stands in all texts; as many rows as templates have words."""
    vocabulary = frozenset(w for t, _, _ in p.all_templates() for w in words_of(t))
    if not vocabulary:
        return {}
    rows = docs.select("text").mapInArrow(_count(vocabulary), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {r["word"].encode(): r["n"] for r in rows.collect()}


def scan_licenses(docs: DataFrame, params: LicenseParams | None = None, columns: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` (struct ``row`` of ``columns``, all by default) with n_words,
    the phrase places (n_base, first_word, last_word, base_labels), labels (phrases and all
    templates found, distinct and sorted), score (1 with a phrase, else the largest share of
    a template found, else 0) and matches (first and last word, template, label, share,
    specific): every place where a block holds enough of a template.

    A null text is empty; an empty one has no words and score 0. Rows are judged one by one,
    so repeated rows agree; very long texts are scanned whole, and blocks are short whatever
    the length of a line. The input's columns are inside ``row``, so none can clash. An empty
    table gives an empty result.
    """
    p = params or LicenseParams()
    counts = word_counts(docs, p)
    cols = docs.columns if columns is None else columns
    slim = docs.select(F.struct(*[docs[f"`{c}`"] for c in cols]).alias("row"), "text")
    return slim.mapInArrow(_scan(p, counts), C.row_schema(slim, SCANNED))
