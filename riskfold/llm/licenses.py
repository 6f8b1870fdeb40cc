"""License scans: an exact set-similarity join of text blocks with license templates.

A text is cut into half-overlapping blocks of twice the longest template's
words, so every passage of a template's length lies whole in one block.  A
block is found for a template when it holds at least ``threshold`` percent of
the template's different words.  The join is that of sets whose words are
ordered by their count in the whole corpus, rarest first:

* prefix filter: a block that holds ``need`` of a template's ``n`` words holds
  one of its ``n - need + 1`` rarest; only blocks with such a word are built;
* length filter: a block with fewer than ``need`` template words is left;
* positional filter: the words that can still be shared after the ones found
  in both prefixes must make up ``need``;
* the pairs left are counted word by word.

The order only decides how much work is saved, never the result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfold.llm.counts import summed
from riskfold.llm.tables import free_name, written
from riskfold.llm.text import Numbers, annotate, pieces, starts_of, sums_of, utf8

#: Phrases and their labels.
PHRASES: tuple[tuple[str, str], ...] = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
#: Notices by which licenses are named or granted, and the labels that they add.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl-2.0-or-later", "under the terms of the GNU General Public License as published by the Free Software Foundation; either "
                         "version 2 of the License, or (at your option) any later version"),
    ("lgpl", "under the terms of the GNU Lesser General Public License"),
    ("agpl", "under the terms of the GNU Affero General Public License"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("mit-notice", "Released under the MIT License"),
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                  "documentation files, to deal in the Software without restriction"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("isc", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0-1.0", "dedicated to the public domain under the CC0 1.0 Universal Public Domain Dedication"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)
#: Percent of a template's different words that a block must hold.
THRESHOLD = 80
#: Words of the templates that one pass holds; more templates take more passes.
MOST_WORDS = 200_000

#: A-Z to a-z, all other ASCII but digits and a-z to a space.
_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)

RESULT = T.StructType([
    T.StructField("n_words", T.LongType(), False),
    T.StructField("n_base", T.LongType(), False),
    T.StructField("first_word", T.LongType()),
    T.StructField("last_word", T.LongType()),
    T.StructField("base_labels", T.ArrayType(T.StringType(), False), False),
    T.StructField("blocks", T.ArrayType(T.StructType([
        T.StructField("label", T.StringType(), False), T.StructField("start", T.LongType(), False),
        T.StructField("end", T.LongType(), False), T.StructField("share", T.DoubleType(), False),
    ]), False), False),
])
_LABELS = pa.list_(pa.field("element", pa.string(), False))
_BLOCK = pa.struct([
    pa.field("label", pa.string(), False), pa.field("start", pa.int64(), False),
    pa.field("end", pa.int64(), False), pa.field("share", pa.float64(), False),
])


def normal_words(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and of all characters beyond ASCII; A-Z in lower case."""
    return text.translate(_TABLE).split()


def _numbers_of(texts: list[bytes], numbers: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all words of the texts in a row (-1: none), and each text's count of words."""
    each = [normal_words(t) for t in texts]
    counts = np.fromiter(map(len, each), dtype=np.int64, count=len(each))
    parts = [np.fromiter(map(numbers.get, w, repeat(-1)), dtype=np.int32, count=len(w)) for w in each]
    return (np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32)), counts


class Phrases:
    """Places of phrases: runs of consecutive words."""

    def __init__(self, phrases: Sequence[tuple[str, str]]):
        self.numbers = Numbers()
        self.phrases = [([self.numbers[w] for w in normal_words(p.encode())], label) for p, label in phrases]
        if any(not p for p, _ in self.phrases):
            raise ValueError("a phrase without words")
        self.numbers = dict(self.numbers)

    def find(self, numbers: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, first word in that text and phrase of each place, in order of texts and words."""
        held = np.flatnonzero(numbers >= 0)  # few words are in a phrase
        text = np.searchsorted(starts, held, side="right") - 1
        at, which = [], []
        for p, (phrase, _) in enumerate(self.phrases):
            here = held[(numbers[held] == phrase[0]) & (held + len(phrase) <= starts[text + 1])]
            for i, w in enumerate(phrase[1:], 1):
                here = here[numbers[here + i] == w]
            at.append(here)
            which.append(np.full(len(here), p))
        at, which = np.concatenate(at), np.concatenate(which)
        order = np.lexsort((which, at))
        at, which = at[order], which[order]
        text = np.searchsorted(starts, at, side="right") - 1
        return text, at - starts[text], which


class Templates:
    """Template sets over words ordered by their corpus count, rarest first, and the filters' tables."""

    def __init__(self, templates: Sequence[tuple[str, str]], counts: dict[bytes, int], threshold: int, half: int):
        self.labels = [label for label, _ in templates]
        self.half = half
        sets = [set(normal_words(t.encode())) for _, t in templates]
        ordered = sorted(set().union(*sets) if sets else (), key=lambda w: (counts.get(w, 0), w))
        self.numbers = {w: i for i, w in enumerate(ordered)}
        each = [np.sort(np.array([self.numbers[w] for w in s], dtype=np.int64)) for s in sets]
        self.sizes = np.array([len(s) for s in each], dtype=np.int64)
        self.need = -(-threshold * self.sizes // 100)
        # the prefixes by word: templates that have the word among their rarest, and its place there
        places = [(w, t, i) for t, s in enumerate(each) for i, w in enumerate(s[: len(s) - self.need[t] + 1].tolist())]
        places.sort()
        table = np.array(places, dtype=np.int64).reshape(-1, 3)
        self.prefix_starts = np.searchsorted(table[:, 0], np.arange(len(ordered) + 1))
        self.prefix_template, self.prefix_place = table[:, 1], table[:, 2]
        # all words by template, as sorted codes
        self.members = np.concatenate([t * len(ordered) + s for t, s in enumerate(each)]) if each else np.zeros(0, dtype=np.int64)

    def find(self, numbers: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text, block number in that text, template and shared words of every block that meets the threshold."""
        none = np.zeros(0, dtype=np.int64)
        held = np.flatnonzero(numbers >= 0)
        word = numbers[held].astype(np.int64)
        text = np.searchsorted(starts, held, side="right") - 1
        n = starts[text + 1] - starts[text]
        last = np.maximum(0, -(-n // self.half) - 2)  # a later block would lie in this one
        block = (held - starts[text]) // self.half
        # each word is in the block that starts in its half and in the one before
        most = int(last.max(initial=0)) + 1
        keys = np.concatenate((text * most + block, text * most + block - 1))
        inside = np.concatenate((block <= last, block > 0))
        words = np.concatenate((word, word))
        keys, words = keys[inside], words[inside]
        # prefix filter: only blocks with a word of some template's prefix
        rare = self.prefix_starts[words + 1] > self.prefix_starts[words]
        chosen = np.unique(keys[rare])
        if not len(chosen):
            return none, none, none, none
        mine = np.minimum(np.searchsorted(chosen, keys), len(chosen) - 1)
        in_chosen = chosen[mine] == keys
        width = len(self.numbers)
        sets = np.unique(mine[in_chosen] * width + words[in_chosen])  # each block's set, rarest first
        owner, words = sets // width, sets % width
        begin = np.searchsorted(owner, np.arange(len(chosen) + 1))
        size, place = np.diff(begin), np.arange(len(sets)) - begin[owner]
        # matches of block words with template prefixes
        times = self.prefix_starts[words + 1] - self.prefix_starts[words]
        i = np.repeat(np.arange(len(sets)), times)
        p = np.repeat(self.prefix_starts[words] - starts_of(times)[:-1], times) + np.arange(len(i))
        b, t = owner[i], self.prefix_template[p]
        need = self.need[t]
        # length filter, and the block's own prefix
        keep = (size[b] >= need) & (place[i] <= size[b] - need)
        b, t, need, at_block, at_template = b[keep], t[keep], need[keep], place[i][keep], self.prefix_place[p][keep]
        order = np.lexsort((at_block, t, b))
        b, t, need, at_block, at_template = (x[order] for x in (b, t, need, at_block, at_template))
        if not len(b):
            return none, none, none, none
        # positional filter: matches so far and what can still come after each of them
        heads = np.flatnonzero(np.concatenate(([True], (b[1:] != b[:-1]) | (t[1:] != t[:-1]))))
        so_far = np.arange(len(b)) - np.repeat(heads, np.diff(np.append(heads, len(b)))) + 1
        bound = so_far + np.minimum(self.sizes[t] - at_template, size[b] - at_block) - 1
        alive = np.minimum.reduceat(bound - need, heads) >= 0
        b, t = b[heads][alive], t[heads][alive]
        if not len(b):
            return none, none, none, none
        # the pairs left, word by word
        i = np.repeat(begin[b] - starts_of(size[b])[:-1], size[b])
        i = i + np.arange(len(i))
        codes = np.repeat(t, size[b]) * width + words[i]
        spot = np.minimum(np.searchsorted(self.members, codes), len(self.members) - 1)
        shared = sums_of((self.members[spot] == codes).astype(np.int64), starts_of(size[b]))
        found = shared >= self.need[t]
        b, t, shared = b[found], t[found], shared[found]
        return chosen[b] // most, chosen[b] % most, t, shared


def word_counts(docs: DataFrame, text_col: str, words: Sequence[bytes]) -> dict[bytes, int]:
    """How often each of ``words`` stands in all whole texts: one total a word reaches the driver."""
    words = list(words)

    def add():
        numbers = {w: i for i, w in enumerate(words)}

        def more(batch, totals):
            for part in pieces(batch, 0):
                found, _ = _numbers_of(utf8(part.column(0)), numbers)
                totals += np.bincount(found[found >= 0], minlength=len(totals))

        return more

    if not words:
        return {}
    return dict(zip(words, summed(docs.select(text_col), len(words), add, "license-words").tolist()))


def _groups(templates: Sequence[tuple[str, str]]) -> Iterator[list[tuple[str, str]]]:
    """The templates in groups of ``MOST_WORDS`` words, or of one template."""
    group, size = [], 0
    for label, text in templates:
        n = len(normal_words(text.encode()))
        if group and size + n > MOST_WORDS:
            yield group
            group, size = [], 0
        group.append((label, text))
        size += n
    yield group


def scan(
    docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES,
    text_col: str = "text", into: str = "licenses", threshold: int = THRESHOLD,
) -> DataFrame:
    """``docs`` with a struct ``into``: places of the phrases, and every block found for a template.

    ``templates``: ``(label, text)``; ``phrases``: ``(text, label)``.  Word
    numbers count from 0 in the text; ``end`` is exclusive; ``share`` is the
    share of the template's different words in the block; ``blocks`` come by
    start, then in the order of the templates.  A null, empty or wordless text
    has no places and no blocks; ``first_word`` and ``last_word`` are then
    null.  Whole texts are read, however long.  Rows need no key, may repeat
    and pass through with all columns; ``into`` gets underscores before it
    while a column has that name.  Empty tables stay empty.
    """
    if not 0 < threshold <= 100:
        raise ValueError("threshold: percent above 0")
    templates = [(label, t) for label, t in templates if normal_words(t.encode())]
    half = max([1, *(len(normal_words(t.encode())) for _, t in templates)])
    groups = list(_groups(templates))
    columns, into = docs.columns, free_name(docs, into)
    for g, group in enumerate(groups):
        vocabulary = sorted(set().union(*(normal_words(t.encode()) for _, t in group))) if group else []
        counts = word_counts(docs, text_col, vocabulary)
        name = into if g == 0 else free_name(docs, f"{into}_{g}")
        docs = annotate(docs, text_col, name, RESULT, _finder(group, counts, phrases, threshold, half))
        if g:  # one group's tables in memory at a time
            blocks = F.array_sort(
                F.concat(f"{into}.blocks", f"{name}.blocks"), lambda x, y: F.coalesce(F.signum(x["start"] - y["start"]), F.lit(0)).cast("int"))
            docs = docs.withColumn(into, F.col(into).withField("blocks", blocks)).drop(name)
        if len(groups) > 1:
            docs = written(docs, "licenses")
    return docs.select(*[F.col(f"`{c}`") for c in columns], into)


def _finder(group, counts, phrases, threshold, half):
    def make():
        places, found = Phrases(phrases), Templates(group, counts, threshold, half)
        # words of either kind, with both numbers
        both = {w: i for i, w in enumerate(sorted({*places.numbers, *found.numbers}))}
        of_phrase, of_template = (
            np.array([x.get(w, -1) for w in both] + [-1], dtype=np.int32) for x in (places.numbers, found.numbers))
        labels = [label for _, label in places.phrases]

        def work(texts: pa.Array) -> dict[str, pa.Array]:
            numbers, n = _numbers_of(utf8(texts), both)
            starts = starts_of(n)
            text, word, phrase = places.find(of_phrase[numbers], starts)
            cuts = np.searchsorted(text, np.arange(len(n) + 1))
            n_base = np.diff(cuts)
            has = n_base > 0
            first, last = np.zeros(len(n), dtype=np.int64), np.zeros(len(n), dtype=np.int64)
            first[has], last[has] = word[cuts[:-1][has]], word[cuts[1:][has] - 1]
            base = [sorted({labels[p] for p in phrase[a:b]}) for a, b in zip(cuts, cuts[1:])]
            text, block, template, shared = found.find(of_template[numbers], starts)
            order = np.lexsort((template, block, text))
            text, block, template, shared = (x[order] for x in (text, block, template, shared))
            begin = block * half
            structs = pa.StructArray.from_arrays([
                pa.array([found.labels[t] for t in template.tolist()], pa.string()), pa.array(begin),
                pa.array(np.minimum(begin + 2 * half, n[text] if len(text) else begin)),
                pa.array(shared / found.sizes[template] if len(template) else np.zeros(0)),
            ], fields=list(_BLOCK))
            cuts = pa.array(np.searchsorted(text, np.arange(len(n) + 1)), pa.int32())
            return {
                "n_words": pa.array(n), "n_base": pa.array(n_base.astype(np.int64)),
                "first_word": pa.array(first, mask=~has), "last_word": pa.array(last, mask=~has),
                "base_labels": pa.array(base, _LABELS),
                "blocks": pa.ListArray.from_arrays(cuts, structs).cast(pa.list_(pa.field("element", _BLOCK, False))),
            }

        return work

    return make


def labels_of(scanned: Column) -> Column:
    """The labels of phrases and blocks, each once, sorted."""
    return F.array_sort(F.array_distinct(F.concat(scanned["base_labels"], scanned["blocks"]["label"])))


def score_of(scanned: Column) -> Column:
    """1 where a phrase stands, else the largest share of a template found in a block, else 0."""
    return F.when(scanned["n_base"] > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(scanned["blocks"]["share"]), F.lit(0.0)))
