"""Cross-tokenizer alignment by diagonal run skipping.

Two tokenizers cut the same bytes; the ends of their tokens are two rising
arrays.  At the current shift between the arrays' indices, equal ends form a
run on a diagonal: probes of doubling length compare stretches of both arrays
at once and a search by halves finds where the run ends, so one-to-one
stretches are jumped.  Between runs the side that is behind steps on until
both ends agree again; the group so closed may have several tokens on either
side, and the shift is then a new one.

A linked pair of tokens ends at the same byte of the same text, so one's bytes
are a suffix of the other's.  The pairs that can ever be linked follow from
the two vocabularies alone: their table is of fixed size whatever the corpus,
and the corpus-wide counts are one array of that size.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from dataclasses import dataclass
from functools import cached_property
from itertools import chain, compress, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfold.llm.bpe import same_as_ranks
from riskfold.llm.counts import summed
from riskfold.llm.tables import written
from riskfold.llm.text import Numbers, byte_symbols, pieces, starts_of, sums_of

PIECE_BYTES = 1 << 18
#: Texts above this length go to the tokenizers library, which has no limit on a run of one kind of characters.
LONG_TEXT = 1 << 19
#: Tokens of a run that are compared one by one; then probes of doubling length follow.
FIRST_PROBE = 16
#: A worker keeps the ids of so many different segments, then drops those that it has met only once.
MOST_SEGMENTS = 120_000
#: New segments that are encoded in one call.
TOGETHER = 1_000
#: How byte-level BPE of this vocabulary cuts a text before it merges (a fixed value of the tokenizer).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteTokenizer:
    """Byte-level BPE from a tokenizers file: ids of space and text, and the bytes of each id."""

    def __init__(self, path: str):
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbols, vocabulary = byte_symbols(), spec["model"]["vocab"]
        special = {t["id"] for t in spec["added_tokens"]}
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = token.encode() if i in special else bytes(symbols[c] for c in token)
        rules = [tuple(bytes(symbols[c] for c in t) for t in (m.split(" ") if isinstance(m, str) else m)) for m in spec["model"]["merges"]]
        steps = spec.get("pre_tokenizer") or {}
        #: Whether a space between two other characters always starts a token, whatever stands before it.
        self.splits = not spec.get("normalizer") and steps.get("type") == "ByteLevel" and steps.get("use_regex", True)
        # where ids are ranks, tiktoken gives the same ids several times faster
        self.fast = None
        ranks = {self.bytes[i]: i for i in vocabulary.values() if i not in special}
        if self.splits and same_as_ranks(ranks, rules):
            self.fast = tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def tokenizer(self):
        """The library's own tokenizer, which most workers never need."""
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.path)
        tokenizer.encode_special_tokens = True
        return tokenizer

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is not None and len(text) <= LONG_TEXT:
            return self.fast.encode_to_numpy(" " + text, disallowed_special=()).astype(np.int64)
        return np.array(self.tokenizer.encode(" " + text, add_special_tokens=False).ids, dtype=np.int64)


class PieceTokenizer:
    """A sentencepiece model, which puts a space before the text: its ids, and the bytes of each id."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [
            bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in ((i, self.model.id_to_piece(i)) for i in range(self.model.get_piece_size()))
        ]
        #: Whether no piece goes on with a space after another character.
        self.splits = not any(b" " in t.lstrip(b" ") for t in self.bytes)

    def __call__(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, num_threads=1), dtype=np.int64)


@dataclass(frozen=True)
class Tokenizers:
    """Files of both tokenizers, which all machines have; each worker loads them once."""

    a: str
    b: str

    def load(self) -> "Coder":
        key = (self.a, self.b)
        if key not in _LOADED:
            _LOADED[key] = Coder(ByteTokenizer(self.a), PieceTokenizer(self.b))
        return _LOADED[key]


_LOADED: dict[tuple[str, str], "Coder"] = {}


class Coder:
    """Ids of both tokenizers, each different segment of the texts encoded once.

    A segment starts at the text's start or at a single space between two
    characters that are no white space.  No token of either kind goes on over
    such a space, so a text's ids are its segments' ids in a row.
    """

    def __init__(self, a: ByteTokenizer, b: PieceTokenizer):
        self.both = (a, b)
        self.lengths = tuple(np.fromiter(map(len, t.bytes), dtype=np.int64, count=len(t.bytes)) for t in self.both)
        if any(x.min() < 1 or x.max() > 255 for x in self.lengths):
            raise ValueError("a token has no bytes, or more than 255")
        self.flat = tuple(np.frombuffer(b"".join(t.bytes), dtype=np.uint8) for t in self.both)
        self.first = tuple(starts_of(n)[:-1] for n in self.lengths)
        self.splits = a.splits and b.splits
        self.types = tuple(np.uint16 if len(t.bytes) <= 1 << 16 else np.int32 for t in self.both)
        self._forget()

    def _forget(self, kept: np.ndarray | None = None) -> None:
        """Drop all segments but those numbered ``kept``."""
        kept = np.zeros(0, dtype=np.int64) if kept is None else kept
        if len(kept):
            words = list(self.numbers)
            numbers = Numbers((words[i], n) for n, i in enumerate(kept.tolist()))
            for k in range(2):
                counts = np.diff(self.starts[k])[kept]
                first = starts_of(counts)
                self.ids[k] = self.ids[k][np.repeat(self.starts[k][kept] - first[:-1], counts) + np.arange(first[-1])]
                self.starts[k] = first
            self.numbers, self.whole, self.uses = numbers, self.whole[kept], np.zeros(len(kept), dtype=np.int64)
            return
        self.numbers = Numbers()
        self.ids = [np.zeros(0, dtype=t) for t in self.types]
        self.starts = [np.zeros(1, dtype=np.int64) for _ in self.both]
        self.whole, self.uses = np.zeros(0, dtype=bool), np.zeros(0, dtype=np.int64)

    def segments(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The different segments, the place among them of every segment in a row, and the number of each text."""
        lists = pc.split_pattern(texts, " ")
        flat = lists.flatten().dictionary_encode()
        different, at = flat.dictionary.to_numpy(zero_copy_only=False).tolist(), flat.indices.to_numpy()
        starts = lists.offsets.to_numpy().astype(np.int64)
        # a space beside white space or at a text's end is no cut; it leaves such segments
        spaced = np.fromiter((not s or s[0].isspace() or s[-1].isspace() for s in different), dtype=bool, count=len(different))
        odd = np.flatnonzero(sums_of(spaced[at], starts) if self.splits else np.diff(starts))
        if not len(odd):
            return different, at, np.diff(starts)
        each = [(_CUT.split(t) if self.splits else [t]) if t else [] for t in texts.take(pa.array(odd)).to_pylist()]
        counts, begin = np.diff(starts), starts[:-1].copy()
        counts[odd] = list(map(len, each))
        begin[odd] = len(at) + starts_of(counts[odd])[:-1]
        numbers = Numbers(zip(different, range(len(different))))
        at = np.concatenate((at, np.fromiter(map(numbers.__getitem__, chain.from_iterable(each)), dtype=np.int64, count=counts[odd].sum())))
        at = at[np.repeat(begin - starts_of(counts)[:-1], counts) + np.arange(counts.sum())]
        used = np.zeros(len(numbers), dtype=bool)
        used[at] = True
        return list(compress(numbers, used)), (np.cumsum(used) - 1)[at], counts

    def _one(self, segment: str) -> tuple[list[np.ndarray], bool]:
        got, plain = [t(segment) for t in self.both], b" " + segment.encode()
        whole = all(b"".join(map(t.bytes.__getitem__, x.tolist())) == plain for t, x in zip(self.both, got))
        return got if whole else [x[:0] for x in got], whole

    def _together(self, segments: list[str]) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Ids of segments that start and end with no white space, encoded as one text, and the number of each."""
        text = " ".join(segments)
        plain = np.frombuffer(b" " + text.encode(), dtype=np.uint8)
        # no segment holds a cut, so each of these spaces starts one
        cuts = np.cumsum(np.fromiter(map(len, segments), dtype=np.int64, count=len(segments)) + 1)
        if len(plain) > len(text) + 1:
            cuts = np.append(np.flatnonzero((plain & 0xC0) != 0x80), len(plain))[cuts]
        out = []
        for k, t in enumerate(self.both):
            ids = t(text)
            lengths = self.lengths[k][ids]
            ends = np.cumsum(lengths)
            if not len(ids) or ends[-1] != len(plain):
                return None
            got = self.flat[k][np.repeat(self.first[k][ids] - ends + lengths, lengths) + np.arange(len(plain))]
            at = np.searchsorted(ends, cuts)
            if not np.array_equal(got, plain) or (ends[at] != cuts).any():
                return None
            out.append((ids, np.diff(at, prepend=-1)))
        return out

    def _learn(self, segments: list[str]) -> None:
        """Encode new segments, as many together as can be."""
        order, found, whole = [], [], np.ones(len(segments), dtype=bool)
        plain = [i for i, s in enumerate(segments) if self.splits and not (s[0].isspace() or s[-1].isspace()) and len(s) < 1000]
        alone = sorted(set(range(len(segments))) - set(plain))
        for lo in range(0, len(plain), TOGETHER):
            part = plain[lo:lo + TOGETHER]
            got = self._together([segments[i] for i in part])
            if got is None:
                alone += part
            else:
                order += part
                found.append(got)
        for i in alone:
            ids, whole[i] = self._one(segments[i])
            found.append([(x, np.array([len(x)])) for x in ids])
        order = np.array(order + alone, dtype=np.int64)
        for k in range(2):
            flat, n = (np.concatenate([f[k][x] for f in found]) for x in range(2))
            counts, begin = np.empty(len(order), dtype=np.int64), np.empty(len(order), dtype=np.int64)
            counts[order], begin[order] = n, starts_of(n)[:-1]
            first = starts_of(counts)
            flat = flat[np.repeat(begin - first[:-1], counts) + np.arange(first[-1])]
            self.ids[k] = np.concatenate((self.ids[k], flat.astype(self.types[k])))
            self.starts[k] = np.concatenate((self.starts[k], self.starts[k][-1] + first[1:]))
        self.whole = np.concatenate((self.whole, whole))

    def __call__(self, texts: pa.Array | list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For ``a`` and ``b``, all ids in a row and the number of each text; none for texts that the ids do not give back.

        The piece's different segments are looked up once each.
        """
        texts = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.binary()).cast(pa.string())).fill_null("")
        if len(self.numbers) > MOST_SEGMENTS:
            again = np.flatnonzero(self.uses > 1)
            self._forget(again[np.argsort(-self.uses[again], kind="stable")][:MOST_SEGMENTS // 2])
        known = len(self.numbers)
        different, at, counts = self.segments(texts)
        words = np.fromiter(map(self.numbers.__getitem__, different), dtype=np.int64, count=len(different))[at]
        if len(self.numbers) > known:
            self._learn(list(islice(self.numbers, known, None)))
            self.uses = np.concatenate((self.uses, np.zeros(len(self.numbers) - known, dtype=np.int64)))
        self.uses += np.bincount(words, minlength=len(self.uses))
        whole = sums_of((~self.whole[words]).astype(np.int64), starts_of(counts)) == 0
        words, counts = words[np.repeat(whole, counts)], np.where(whole, counts, 0)
        out = []
        for ids, starts in zip(self.ids, self.starts):
            lengths = starts[words + 1] - starts[words]
            first = starts_of(lengths)
            flat = ids[np.repeat(starts[words] - first[:-1], lengths) + np.arange(first[-1])]
            out.append((flat.astype(np.int64), sums_of(lengths, starts_of(counts))))
        return out


#: A space between two characters that are no white space.
_CUT = re.compile(r"(?<=\S) (?=\S)")


def runs(lengths_a: np.ndarray, lengths_b: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """The maximal runs of equal ends: first index in ``a``, in ``b``, and length.

    ``lengths_a`` and ``lengths_b``: bytes of each token, 1 to 255.  Every end
    that both have is in exactly one run.  Ends are compared from the last
    equal ones on: there, the ends that follow are equal as long as the
    lengths are, so a stretch of ends at the current shift is compared through
    its lengths, a byte each.
    """
    n_a, n_b = len(lengths_a), len(lengths_b)
    a, b = lengths_a.tobytes() + b"\0", lengths_b.tobytes() + b"\0"  # no token has this length
    first_a, first_b, length = [], [], []
    i = j = 0
    while i < n_a and j < n_b:
        ahead = a[i] - b[j]  # how far the end in a is beyond that in b
        while ahead:  # an irregular group: the side behind steps on, and the shift changes
            if ahead < 0:
                i += 1
                if i == n_a:
                    return first_a, first_b, length
                ahead += a[i]
            else:
                j += 1
                if j == n_b:
                    return first_a, first_b, length
                ahead -= b[j]
        p, q = i + 1, j + 1
        singles = p + FIRST_PROBE
        while a[p] == b[q] and p < n_a:  # both are at their ends, or neither is
            p += 1
            q += 1
            if p == singles:  # a longer run: probes of doubling length
                p, q = _probed(a, b, p, q, n_a, n_b)
                break
        first_a.append(i)
        first_b.append(j)
        length.append(p - i)
        i, j = p, q
    return first_a, first_b, length


def _probed(a: bytes, b: bytes, p: int, q: int, n_a: int, n_b: int) -> tuple[int, int]:
    """Where the run ends that has come to ``p`` and ``q``: jump while whole probes are equal, then halve the last one."""
    probe = 2 * FIRST_PROBE
    while True:
        probe = min(probe, n_a - p, n_b - q)
        if not probe:
            return p, q
        if a[p:p + probe] == b[q:q + probe]:
            p, q, probe = p + probe, q + probe, 2 * probe
            continue
        while probe > 1:  # the first that differs lies in this probe
            half = probe // 2
            if a[p:p + half] == b[q:q + half]:
                p, q, probe = p + half, q + half, probe - half
            else:
                probe = half
        return p, q


def linkable(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Sorted codes ``id_a * len(b) + id_b`` of the pairs of which one's bytes are a suffix of the other's."""
    def by_bytes(tokens):
        out: dict[bytes, list[int]] = {}
        for i, t in enumerate(tokens):
            if t:
                out.setdefault(t, []).append(i)
        return out

    ids_a, ids_b, codes = by_bytes(a), by_bytes(b), set()
    for t, ids in ids_a.items():
        for k in range(len(t)):
            codes.update(i * len(b) + j for j in ids_b.get(t[k:], ()) for i in ids)
    for t, ids in ids_b.items():
        for k in range(1, len(t)):
            codes.update(i * len(b) + j for i in ids_a.get(t[k:], ()) for j in ids)
    return np.array(sorted(codes), dtype=np.int64)


class _Digits:
    """Ids as decimal text with the mark after them, for whole arrays at a time."""

    MARKS = b",|;\0"  # \0: no mark

    def __init__(self, size: int):
        self.width = len(str(size - 1)) + 1
        self.rows = np.zeros((size * 4, self.width), dtype=np.uint8)
        for i in range(size):
            digits = str(i).encode()
            for m, mark in enumerate(self.MARKS):
                self.rows[4 * i + m, : len(digits) + 1] = np.frombuffer(digits + bytes([mark]), dtype=np.uint8)
        self.lengths = (self.rows != 0).sum(axis=1)

    def text(self, ids: np.ndarray, marks: np.ndarray) -> tuple[bytes, np.ndarray]:
        """All ids and marks in a row, and the length of each."""
        codes = 4 * ids + marks
        rows = self.rows[codes]
        return rows[rows != 0].tobytes(), self.lengths[codes]


_DIGITS: dict[int, _Digits] = {}
_COMMA, _BAR, _SEMICOLON, _NOTHING = range(4)

ALIGNED = T.StructType([
    T.StructField("n_a", T.LongType(), False), T.StructField("n_b", T.LongType(), False),
    T.StructField("n_groups", T.LongType(), False), T.StructField("groups_sha256", T.StringType(), False),
    T.StructField("links", T.ArrayType(T.IntegerType(), False), False),
])
GROUPS = [
    T.StructField("group_a", T.ArrayType(T.IntegerType(), False), False),
    T.StructField("group_b", T.ArrayType(T.IntegerType(), False), False),
]


def align(
    docs: DataFrame, tokenizers: Tokenizers, id_col: str = "doc_id", text_col: str = "text", with_groups: bool = False,
) -> DataFrame:
    """``id, n_a, n_b, n_groups, groups_sha256, links`` of every row.

    ``links`` has a number for each end that both tokenizers have: that of the
    pair of ids in :func:`linkable`.  ``groups_sha256`` digests the groups as
    ``a1,a2|b1;a3|b2,b3``.  ``with_groups`` adds ``group_a`` and ``group_b``,
    the tokens of each group.  A null or empty text has no tokens, and neither
    has one whose tokens of either kind do not give space and text back: zeros,
    an empty digest, no links.  Ids may be null or repeat: each row is aligned
    by itself.  Other columns are not read.  Empty tables stay empty.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["id"], *ALIGNED.fields, *(GROUPS if with_groups else [])])
    pairs = rows.sparkSession.sparkContext.broadcast(_pairs(tokenizers))  # fixed by the two vocabularies

    def run(batches):
        coder = tokenizers.load()
        most = max(map(len, coder.lengths))
        if most not in _DIGITS:
            _DIGITS[most] = _Digits(most)
        for batch in batches:
            for part in pieces(batch, 1, PIECE_BYTES):
                got = _aligned(part.column(1), coder, pairs.value, _DIGITS[most], with_groups)
                yield pa.RecordBatch.from_arrays([part.column(0), *got], names=schema.names)

    return rows.mapInArrow(run, schema)


def _pairs(tokenizers: Tokenizers) -> np.ndarray:
    a, b = tokenizers.load().both
    return linkable(a.bytes, b.bytes)


def _aligned(texts: pa.Array, coder: Coder, pairs: np.ndarray, digits: _Digits, with_groups: bool):
    (flat_a, n_a), (flat_b, n_b) = coder(texts)
    lengths = [n[x].astype(np.uint8) for n, x in zip(coder.lengths, (flat_a, flat_b))]
    starts_a, starts_b = starts_of(n_a), starts_of(n_b)
    first_a, first_b, length, n_runs = [], [], [], []
    for lo_a, hi_a, lo_b, hi_b in zip(starts_a.tolist(), starts_a[1:].tolist(), starts_b.tolist(), starts_b[1:].tolist()):
        i, j, n = runs(lengths[0][lo_a:hi_a], lengths[1][lo_b:hi_b])
        first_a += i
        first_b += j
        length += n
        n_runs.append(len(n))
    n_runs, length = np.array(n_runs, dtype=np.int64), np.array(length, dtype=np.int64)
    n_groups = sums_of(length, starts_of(n_runs))
    # groups of all texts in a row: their ends in the flat arrays
    step = np.arange(length.sum()) - np.repeat(starts_of(length)[:-1], length) + 1
    end_a, end_b = (
        np.repeat(np.array(first, dtype=np.int64) + np.repeat(starts[:-1], n_runs), length) + step
        for first, starts in ((first_a, starts_a), (first_b, starts_b)))
    size_a, size_b = np.diff(end_a, prepend=0), np.diff(end_b, prepend=0)
    # the text of the groups: each group's a tokens, then its b tokens
    marks_a, marks_b = np.full(len(flat_a), _COMMA), np.full(len(flat_b), _COMMA)
    marks_a[end_a - 1], marks_b[end_b - 1] = _BAR, _SEMICOLON
    marks_b[starts_b[1:][n_b > 0] - 1] = _NOTHING
    place_a = np.arange(len(flat_a)) + np.repeat(end_b - size_b, size_a)
    place_b = np.arange(len(flat_b)) + np.repeat(end_a, size_b)
    ids, marks = (np.empty(len(flat_a) + len(flat_b), dtype=np.int64) for _ in range(2))
    ids[place_a], ids[place_b], marks[place_a], marks[place_b] = flat_a, flat_b, marks_a, marks_b
    string, lengths = digits.text(ids, marks)
    ends = sums_of(lengths, starts_of(n_a + n_b)).cumsum()
    view = memoryview(string)
    digests = [hashlib.sha256(view[lo:hi]).hexdigest() if hi > lo else "" for lo, hi in zip(chain([0], ends.tolist()), ends.tolist())]
    links = np.searchsorted(pairs, flat_a[end_a - 1] * len(coder.lengths[1]) + flat_b[end_b - 1]).astype(np.int32)
    offsets = pa.array(starts_of(n_groups), pa.int32())

    def lists(values):
        return pa.ListArray.from_arrays(offsets, pa.array(values, pa.int32())).cast(pa.list_(pa.field("element", pa.int32(), False)))

    out = [pa.array(n_a), pa.array(n_b), pa.array(n_groups), pa.array(digests, pa.string()), lists(links)]
    return out + ([lists(size_a), lists(size_b)] if with_groups else [])


def link_counts(aligned: DataFrame, n_pairs: int):
    """How many links of the whole corpus have each pair: one array of fixed size."""

    def add():
        def more(batch, totals):
            lists = batch.column(0)
            lo, hi = lists.offsets[0].as_py(), lists.offsets[-1].as_py()
            totals += np.bincount(np.asarray(lists.values)[lo:hi], minlength=len(totals))

        return more

    return summed(aligned.select("links"), n_pairs, add, "alignment-links")


def aligned_scores(
    docs: DataFrame, tokenizers: Tokenizers, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    ``count_sum`` adds up, over the row's links, how many links of the corpus
    have the same pair of ids; ``n_best`` counts the links whose pair is the
    most frequent one of its ``b`` id, ties included.  Rows without tokens
    have zeros.  See :func:`align` for nulls, repeated rows and empty tables.
    """
    pairs = _pairs(tokenizers)
    aligned = written(align(docs, tokenizers, id_col, text_col), "alignment")
    counts = link_counts(aligned, len(pairs))
    of_b = pairs % len(tokenizers.load().lengths[1])
    most = np.zeros(int(of_b.max()) + 1, dtype=np.int64)
    np.maximum.at(most, of_b, counts)
    held = docs.sparkSession.sparkContext.broadcast((counts, counts == most[of_b]))  # an entry a linkable pair
    plain = ["id", "n_a", "n_b", "n_groups", "groups_sha256"]
    schema = T.StructType([*[aligned.schema[c] for c in plain], *[
        T.StructField(c, T.LongType(), False) for c in ("n_links", "n_best", "count_sum")]])

    def run(batches):
        counts, best = held.value
        for batch in batches:
            lists = batch.column(len(plain))
            offsets = np.asarray(lists.offsets, dtype=np.int64)
            links = np.asarray(lists.values)[offsets[0]:offsets[-1]]
            offsets = offsets - offsets[0]
            yield pa.RecordBatch.from_arrays([
                *batch.columns[: len(plain)], pa.array(np.diff(offsets)),
                pa.array(sums_of(best[links].astype(np.int64), offsets)), pa.array(sums_of(counts[links], offsets)),
            ], names=schema.names)

    return aligned.select(*plain, "links").mapInArrow(run, schema)
