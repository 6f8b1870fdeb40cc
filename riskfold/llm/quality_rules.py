"""Quality rules: repetition found with a suffix array over each text's words.

Suffixes are sorted by prefix doubling, for many texts at once; a suffix that
no other equals so far is settled and leaves the work.  The
longest common prefixes of neighbours in the sorted order form intervals; an
interval that can be extended neither left nor right is a maximal repeat.  The
spans of the repeats of at least ``min_words`` words are united: a text fails
if they cover too large a share of it, or if one repeat is too long.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from riskfold.llm.text import Numbers, annotate, starts_of, sums_of, utf8, words_of

#: Characters counted as symbols, and the base rules' window and limits.
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: Texts measured together: the words, the suffixes and their ranks take some fifty times the texts' bytes.
PIECE_BYTES = 1 << 19


@dataclass(frozen=True)
class RepeatLimits:
    """The verdict of the method: repeats of ``min_words`` words and more may cover
    ``max_covered`` of the words, and none may be longer than ``max_longest`` words."""

    min_words: int = 8
    max_covered: float = 0.15
    max_longest: int = 50


RESULT = T.StructType([
    T.StructField("n_words", T.LongType(), False),
    T.StructField("word_chars", T.LongType(), False),
    T.StructField("n_symbols", T.LongType(), False),
    T.StructField("n_dup_lines", T.LongType(), False),
    T.StructField("n_repeat_words", T.LongType(), False),
    T.StructField("covered_words", T.LongType(), False),
    T.StructField("longest_repeat", T.LongType(), False),
    T.StructField("n_maximal_repeats", T.LongType(), False),
    T.StructField("base_failed", T.BooleanType(), False),
    T.StructField("kept", T.BooleanType(), False),
])


def _heads(keys: np.ndarray) -> np.ndarray:
    """For sorted ``keys``, the index of the first of each run of equal ones."""
    at = np.arange(len(keys))
    return np.maximum.accumulate(np.where(np.concatenate(([True], keys[1:] != keys[:-1])), at, 0))


def _shared(heads: np.ndarray) -> np.ndarray:
    """Which entries of a result of :func:`_heads` belong to a run of two or more."""
    edge = np.concatenate((heads[1:] == heads[:-1], [False]))
    return edge | np.concatenate(([False], edge[:-1]))


class Suffixes:
    """Suffix array of many texts, by words; texts stay apart.

    ``ranks[j]`` orders all suffixes by text and first ``2**j`` words; equal
    ranks mean that these words agree (a suffix with fewer words equals none).
    """

    def __init__(self, words: np.ndarray, counts: np.ndarray):
        n = self.n = len(words)
        self.words = words
        self.text = np.repeat(np.arange(len(counts)), counts)
        self.left = np.repeat(starts_of(counts)[1:], counts) - np.arange(n)  # words from here to the text's end
        self.ranks: list[np.ndarray] = []
        if not n:
            return
        keys = self.text * (int(words.max()) + 1) + words
        at = np.argsort(keys, kind="stable")
        heads = _heads(keys[at])
        rank = np.empty(n, dtype=np.int32)
        rank[at] = heads
        self.ranks.append(rank)
        at, step = at[_shared(heads)], 1
        while len(at):  # only suffixes that do not stand alone yet
            then = np.where(self.left[at] > step, rank[np.minimum(at + step, n - 1)].astype(np.int64) + 1, 0)
            group = rank[at].astype(np.int64)
            keys = group * (n + 1) + then
            order = np.argsort(keys, kind="stable")
            at, heads = at[order], _heads(keys[order])
            rank = rank.copy()
            rank[at] = group[order] + heads - _heads(group[order])
            self.ranks.append(rank)
            at, step = at[_shared(heads)], step * 2

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length in words of the common prefix of the suffixes at ``a`` and ``b`` of equal texts."""
        length = np.zeros(len(a), dtype=np.int64)
        for j in range(len(self.ranks) - 1, -1, -1):
            on = np.flatnonzero((length < self.left[a]) & (length < self.left[b]))
            same = on[self.ranks[j][(a + length)[on]] == self.ranks[j][(b + length)[on]]]
            length[same] += 1 << j
        return length

    def neighbours(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """The suffix array, and the common prefix of each entry with the next (0 if under ``least``)."""
        array = np.empty(self.n, dtype=np.int64)
        array[self.ranks[-1]] = np.arange(self.n)
        j = min(least.bit_length() - 1, len(self.ranks) - 1)
        near = np.flatnonzero(self.ranks[j][array[1:]] == self.ranks[j][array[:-1]])
        lcp = np.zeros(max(0, self.n - 1), dtype=np.int64)
        lcp[near] = self.common(array[near], array[near + 1])
        lcp[lcp < least] = 0
        return array, lcp


def longest_at(array: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """The longest repeat that starts at each position, 0 if none."""
    out = np.zeros(len(array), dtype=np.int64)
    out[array[:-1]] = lcp
    out[array[1:]] = np.maximum(out[array[1:]], lcp)
    return out


def maximal_repeats(s: Suffixes, array: np.ndarray, lcp: np.ndarray) -> list[tuple[int, int, int, int]]:
    """``(text, first start, words, times)`` of the repeats that grow neither left nor right.

    A walk over the LCP intervals with a stack; each open interval keeps the
    word to the left of its suffixes, or notes that these differ.
    """
    on = lcp > 0
    edge = np.concatenate((on, [False])) | np.concatenate(([False], on)) if len(array) else on
    at = np.flatnonzero(edge)  # the entries of the suffix array in some interval
    starts = array[at]
    first = (starts == 0) | (s.text[np.maximum(starts - 1, 0)] != s.text[starts])
    before = np.where(first, -1, s.words[np.maximum(starts - 1, 0)]).tolist()
    heights = np.concatenate((lcp, [0]))[at].tolist()
    out: list[tuple[int, int, int, int]] = []
    stack: list[list] = []  # length, times, smallest start, left word, left words differ
    for start, left, height in zip(starts.tolist(), before, heights):
        run = [0, 1, start, left, left < 0]
        # the suffix itself belongs to the interval with the one before, if open, and with the next
        if stack:
            top = stack[-1]
            top[1] += 1
            top[2] = min(top[2], start)
            top[4] = top[4] or left < 0 or left != top[3]
            run = None
        while stack and stack[-1][0] > height:
            length, times, low, word, differ = stack.pop()
            if differ:
                out.append((int(s.text[low]), low, length, times))
            if stack and stack[-1][0] >= height:
                up = stack[-1]
                up[1] += times
                up[2] = min(up[2], low)
                up[4] = up[4] or differ or word != up[3]
            elif height:
                stack.append([height, times, low, word, differ])
        if height and (not stack or stack[-1][0] < height):
            stack.append([height, 1, start, left, left < 0])
        elif height and run is not None:
            stack.append([height, 1, start, left, left < 0])
    return out


def _covered(longest: np.ndarray) -> np.ndarray:
    """Which positions lie in a span of ``longest`` words from a position on."""
    at = np.arange(len(longest))
    return np.maximum.accumulate(np.where(longest > 0, at + longest, 0)) > at if len(at) else at.astype(bool)


def _dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def _counts_of(texts: list[bytes], wanted: np.ndarray) -> np.ndarray:
    """How many bytes of each text are wanted (a table of 256 flags)."""
    flat = np.frombuffer(b"".join(texts), dtype=np.uint8)
    starts = starts_of(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)))
    return sums_of(wanted[flat], starts)


_IS_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS, dtype=np.uint8))
_IS_WORD_CHAR = np.array([(b & 0xC0) != 0x80 and b != 0x20 and not 0x09 <= b <= 0x0D for b in range(256)])


def measures(texts: list[bytes], limits: RepeatLimits) -> dict[str, np.ndarray]:
    """All counts and verdicts of a list of texts."""
    flat, counts = words_of(texts)
    numbers = Numbers()
    words = np.fromiter(map(numbers.__getitem__, flat), dtype=np.int64, count=len(flat))
    starts = starts_of(counts)
    s = Suffixes(words, counts)
    array, lcp = s.neighbours(min(WINDOW, limits.min_words)) if s.n else (words, words[:0])
    longest = longest_at(array, lcp)
    repeated = sums_of(_covered(np.where(longest >= WINDOW, WINDOW, 0)).astype(np.int64), starts)
    found = maximal_repeats(s, array, np.where(lcp >= limits.min_words, lcp, 0))
    longest[longest < limits.min_words] = 0
    covered = sums_of(_covered(longest).astype(np.int64), starts)
    top = np.zeros(len(texts), dtype=np.int64)
    np.maximum.at(top, s.text, longest)
    base_failed = (counts < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * counts)
    return {
        "n_words": counts, "word_chars": _counts_of(texts, _IS_WORD_CHAR), "n_symbols": _counts_of(texts, _IS_SYMBOL),
        "n_dup_lines": np.fromiter(map(_dup_lines, texts), dtype=np.int64, count=len(texts)),
        "n_repeat_words": repeated, "covered_words": covered, "longest_repeat": top,
        "n_maximal_repeats": np.bincount([r[0] for r in found] or np.zeros(0, np.int64), minlength=len(texts)).astype(np.int64),
        "base_failed": base_failed,
        "kept": ~base_failed & (covered <= limits.max_covered * counts) & (top <= limits.max_longest),
    }


def quality(
    docs: DataFrame, text_col: str = "text", into: str = "__quality", limits: RepeatLimits = RepeatLimits(),
) -> DataFrame:
    """``docs`` with a struct ``into`` of the base counts, the repeats and the verdict ``kept``.

    Null and empty texts have no words and fail the base rules.  Texts are
    measured whole, each by itself: rows may repeat, an empty table stays
    empty, and extra columns of any name but ``into`` pass through.
    """

    def make():
        def work(texts: pa.Array) -> dict[str, pa.Array]:
            return {k: pa.array(v) for k, v in measures(utf8(texts), limits).items()}

        return work

    return annotate(docs, text_col, into, RESULT, make, PIECE_BYTES)
