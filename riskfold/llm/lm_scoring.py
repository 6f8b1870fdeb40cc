"""Language-model scoring with a Brown class-based bigram model.

``P(word | before) = P(class | class before) * P(word | class)``.  All counts
are over the whole training corpus:

1. Word counts, a shuffle by word.  All words counted twice or more have a
   number, by count and then by word.  The first ``KNOWN_WORDS`` of them reach
   the tasks as a dictionary, so each text becomes a list of numbers with its
   other words beside it; those get their numbers by a join.
2. The start, by exchange clustering on the driver: the bigrams of the
   ``EXCHANGE_WORDS`` most frequent words are counted, and words move one by one
   to the class that gains the most likelihood.
3. The bigrams of all other words are counted once, into a table with a row a
   word: its neighbours on both sides, and how often each stands there.
4. Sweeps over all words, the first ones too: the classes before and after
   each word are counted from that table, and each joins the class under which
   these are likeliest, until few move.  A sweep reads the table twice and
   shuffles nothing; the classes of the words are a byte each in a broadcast.
5. Transitions between classes are counted and smoothed.  Words seen once, and
   unseen ones, are a class of their own, whose emissions come from their
   counts by a join; the end of a text is a class, and the context of a text's
   first word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfold.llm.counts import summed
from riskfold.llm.tables import ROW, dropped, totals_before, with_row_ids, written
from riskfold.llm.text import numbered_words, pieces, starts_of, sums_of

#: Classes, words that start the clustering, words in the dictionary of the tasks (all others are joined).
CLASSES = 32
EXCHANGE_WORDS = 1024
KNOWN_WORDS = 524_288
#: Words whose classes are a broadcast of a byte each.  Words beyond take part in no sweep; each then joins
#: the class that suits it best among the settled ones.
SWEPT_WORDS = 1 << 24
SWEEPS = 8
#: Entries of the neighbour table that a task works on at a time.
MOST_ENTRIES = 200_000
#: Sweeps over all words end when less than this share of the tokens would move, at this gain in nats a
#: token, or when moves lose even if only one word in so many moves at once.
FEW_MOVES = 0.01
LEAST_GAIN = 0.005
MOST_PARTS = 16
#: Smoothing: pseudo-count of a class's share in each transition, and of a rare word.
TRANSITION_MASS = 5.0
RARE_MASS = 1.0
#: The end of a text as a word; no word holds white space.
END = "\n"
#: A task counts and numbers the words of so many bytes of text at a time; it sorts and counts so many neighbours at a time.
COUNTED_BYTES = 16 << 20
MOST_COUNTED = 4_000_000
#: Steps of the histogram of counts, per doubling.
STEPS = 16


def trained(doc_id: Column) -> Column:
    """Rows whose CRC-32 of the id as text does not leave 2 by 7; a null id is the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 != 2


def count_words(docs: DataFrame, text_col: str) -> DataFrame:
    """``word, n`` over all texts, lower-cased; each text also counts one ``END``."""

    def run(batches):
        for batch in batches:
            for part in pieces(batch, 0, COUNTED_BYTES):
                words, at, counts = numbered_words(part.column(0), lower=True)
                yield pa.RecordBatch.from_arrays([
                    pa.concat_arrays([words, pa.array([END], words.type)]),
                    pa.array(np.append(np.bincount(at, minlength=len(words)), len(counts)).astype(np.int64)),
                ], names=["word", "n"])

    return docs.select(text_col).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _step(n: Column) -> Column:
    return F.floor(F.log2(n) * STEPS).cast("int")


def known_words(vocabulary: DataFrame, most: int) -> tuple[list[str], np.ndarray, int]:
    """The words above some count, most frequent first, their counts, and the histogram step they start at.

    Words seen once are never among them: they stand for the unseen ones.  A step of the histogram is taken whole or not, so the rows that reach the
    driver are at most ``most``, and no sort of all words is needed.
    """
    words = vocabulary.where((F.col("word") != END) & (F.col("n") > 1))
    steps = words.groupBy(_step(F.col("n")).alias("step")).count().collect()  # STEPS x 63 rows at most
    total, first = 0, 1 << 30
    for r in sorted(steps, key=lambda r: -r["step"]):
        total += r["count"]
        if total > most:
            break
        first = r["step"]
    rows = words.where(_step(F.col("n")) >= first).select("word", "n").toArrow()
    rows = rows.sort_by([("n", "descending"), ("word", "ascending")])  # by code point, as Spark orders text
    return rows.column("word").to_pylist(), rows.column("n").to_numpy().astype(np.int64), first


ENCODED = T.StructType([
    T.StructField("ids", T.ArrayType(T.IntegerType(), False), False),
    T.StructField("rare", T.ArrayType(T.StructType([
        T.StructField("word", T.StringType(), False), T.StructField("at", T.IntegerType(), False),
        T.StructField("left", T.IntegerType(), False), T.StructField("right", T.IntegerType(), False),
    ]), False), False),
])


def encode(docs: DataFrame, text_col: str, words: list[str]) -> DataFrame:
    """``docs`` with ``text_col`` replaced by ``ids`` and ``rare``.

    A number for each word of ``words``, then ``len(words)`` for all others and
    ``len(words) + 1`` at the end of each text.  ``rare`` has these others in
    order, with their place and the numbers beside them.
    """
    held = docs.sparkSession.sparkContext.broadcast(pa.array(words, pa.string()))  # KNOWN_WORDS words at most
    at = docs.columns.index(text_col)
    keep = [i for i in range(len(docs.columns)) if i != at]
    schema = T.StructType([*[docs.schema.fields[i] for i in keep], *ENCODED.fields])
    rare_type = pa.struct([pa.field("word", pa.string(), False), *[pa.field(n, pa.int32(), False) for n in ("at", "left", "right")]])

    def run(batches):
        k = len(held.value)
        for batch in batches:
            for part in pieces(batch, at, COUNTED_BYTES):
                different, place, counts = numbered_words(part.column(at), lower=True)
                different = different.cast(pa.string())
                ids = pc.index_in(different, value_set=held.value).fill_null(k).to_numpy()[place]
                starts = starts_of(counts)
                with_end = np.insert(ids, starts[1:], k + 1)
                others = np.flatnonzero(ids == k)
                text = np.searchsorted(starts, others, side="right") - 1
                places = others + text  # in with_end: one end a text before
                pairs = pa.StructArray.from_arrays([
                    different.take(pa.array(place[others])),
                    pa.array((others - starts[text]).astype(np.int32)),
                    pa.array(_before(with_end, k + 1)[places].astype(np.int32)), pa.array(with_end[places + 1].astype(np.int32)),
                ], fields=list(rare_type))
                ends = np.searchsorted(others, starts)
                rows = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs).cast(
                    pa.list_(pa.field("element", rare_type, False)))
                lists = pa.ListArray.from_arrays(pa.array(starts_of(counts + 1), pa.int32()), pa.array(with_end, pa.int32())).cast(
                    pa.list_(pa.field("element", pa.int32(), False)))
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in keep], lists, rows], names=schema.names)

    return docs.mapInArrow(run, schema)


def _ids(batch: pa.RecordBatch, column: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all rows in a row, and their offsets."""
    lists = batch.column(column)
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    return np.asarray(lists.values)[offsets[0]:offsets[-1]], offsets - offsets[0]


def _before(values: np.ndarray, end: int) -> np.ndarray:
    """What stands before each; every text ends with ``end``, which so stands before the next one's first."""
    return np.concatenate(([end], values[:-1]))


def _h(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(bigrams: np.ndarray, classes: int, sweeps: int = SWEEPS) -> np.ndarray:
    """Classes of the first ``n - 2`` words of ``bigrams`` (n x n counts of before, after).

    The last two (all other words, the end) keep classes of their own, which
    are numbered last.  Each word in turn leaves its class and joins the one
    with the largest gain in the likelihood of the class bigram model.
    """
    n = len(bigrams) - 2
    classes = min(classes, max(1, n))
    of = np.concatenate((np.arange(n) % classes, [classes, classes + 1]))
    total = classes + 2
    member = np.zeros((n + 2, total))
    member[np.arange(n + 2), of] = 1
    counts = bigrams.astype(float)
    after = counts @ member  # n x classes: how often a class follows the word
    ahead = counts.T @ member  # how often a class comes before the word
    table = member.T @ after
    times_first, times_second = counts.sum(axis=1), counts.sum(axis=0)
    size_first, size_second = member.T @ times_first, member.T @ times_second
    return exchanged(counts, of, after, ahead, table, size_first, size_second, times_first, times_second, classes, sweeps)


def exchanged(counts, of, after, ahead, table, size_first, size_second, times_first, times_second, classes: int, sweeps: int):
    """The classes ``of`` after sweeps over the first ``len(counts) - 2`` words; all counts, of classes of any words, follow in place."""
    n = len(counts) - 2
    for _ in range(sweeps):
        moved = 0
        for w in range(n):
            a, own = of[w], counts[w, w]
            # contexts without the word itself, which moves along
            f, p = after[w].copy(), ahead[w].copy()
            f[a] -= own
            p[a] -= own
            table[a] -= f
            table[:, a] -= p
            table[a, a] -= own
            size_first[a] -= times_first[w]
            size_second[a] -= times_second[w]
            gain = gains(table, size_first, size_second, f, p, own, times_first[w], times_second[w], classes)
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            table[b] += f
            table[:, b] += p
            table[b, b] += own
            size_first[b] += times_first[w]
            size_second[b] += times_second[w]
            if b != a:
                moved += 1
                of[w] = b
                after[:, a] -= counts[:, w]
                after[:, b] += counts[:, w]
                ahead[:, a] -= counts[w]
                ahead[:, b] += counts[w]
        if not moved:
            break
    return of


def gains(table, size_first, size_second, after, ahead, own, first, second, classes: int) -> np.ndarray:
    """Gain in log-likelihood of adding a word (its contexts) to each of the ``classes``, all at once.

    ``table``, ``size_first`` and ``size_second`` do not hold the word.
    """
    c = np.arange(classes)
    held, corner = _h(table), np.diagonal(table)[:classes]
    rows = _h(table[:classes] + after) - held[:classes]
    columns = _h(table[:, :classes] + ahead[:, None]) - held[:, :classes]
    rows[c, c] = columns[c, c] = 0
    return (
        rows.sum(axis=1) + columns.sum(axis=0) + _h(corner + after[:classes] + ahead[:classes] + own) - _h(corner)
        - _h(size_first[:classes] + first) + _h(size_first[:classes]) - _h(size_second[:classes] + second) + _h(size_second[:classes])
    )


@dataclass
class ClassModel:
    """Classes of the numbers (known words, other words, end) and logarithms to base 10."""

    classes: np.ndarray
    moves: np.ndarray  # class before x class
    sizes: np.ndarray  # tokens of each class
    emits: np.ndarray  # of each number; 0 for other words, whose emissions are joined
    unigram: np.ndarray  # of each number, add-one; for other words without their count
    tokens: int
    types: int
    rare_total: float  # what a rare word's count plus RARE_MASS is divided by

    @property
    def seen_end(self) -> int:
        return int(self.tokens > 0)


def best_classes(table: np.ndarray, sizes: np.ndarray, around: np.ndarray, times: np.ndarray, of: np.ndarray, classes: int) -> np.ndarray:
    """The class of largest gain for each word; a word keeps its class ``of`` unless another gains more.

    ``around`` has a row a word: counts of the class before it, of the class
    after it, and of the word after itself.  ``table`` and ``sizes`` hold all
    words; a word is taken out of its own class, if that is one of ``classes``.
    """
    out = np.array(of)
    for lo in range(0, len(out), 2048):
        part = slice(lo, lo + 2048)
        out[part] = _best(table.astype(float), sizes.astype(float), around[part].astype(float), times[part].astype(float), out[part], classes)
    return out


def _best(table, sizes, around, times, of, classes: int) -> np.ndarray:
    width, words = len(table), np.arange(len(around))
    ahead, after, own = around[:, :width].copy(), around[:, width:2 * width].copy(), around[:, 2 * width]
    ahead[words, of] -= own  # contexts without the word itself, which moves along
    after[words, of] -= own
    leaves = of < classes
    mine = np.where(leaves, of, 0)

    def added(contexts, others, cells):
        """Gain in the cells of each class (a row) with the contexts' classes, but its own."""
        gain = np.zeros((len(contexts), classes))
        i, d = np.nonzero(contexts)
        if len(i):
            n, at = contexts[i, d], cells[:classes, d].T
            more = _h(at + n[:, None]) - _h(at)
            r = np.flatnonzero(d < classes)
            more[r, d[r]] = 0
            more[leaves[i] & (d == mine[i])] = 0
            r = np.flatnonzero(leaves[i] & (d != mine[i]))
            at = cells[mine[i[r]], d[r]]  # holds the word
            more[r, mine[i[r]]] = _h(at) - _h(at - n[r])
            first = np.flatnonzero(np.concatenate(([True], i[1:] != i[:-1])))
            gain[i[first]] = np.add.reduceat(more, first)
        at = cells[:classes, mine].T - others[:, :classes]  # beside the class that the word leaves
        more = _h(at + contexts[words, mine][:, None]) - _h(at)
        more[words, mine] = 0
        return gain + np.where(leaves[:, None], more, 0)

    corner, beside, size = np.diagonal(table)[:classes], ahead[:, :classes] + after[:, :classes] + own[:, None], sizes[:classes]
    rest = _h(corner + beside) - _h(corner) - 2 * (_h(size + times[:, None]) - _h(size))
    at, n = table[mine, mine], beside[words, mine]
    back = _h(at) - _h(at - n) - 2 * (_h(size[mine]) - _h(size[mine] - times))
    rest[words, mine] = np.where(leaves, back, rest[words, mine])
    gain = added(after, ahead, table) + added(ahead, after, table.T) + rest
    best = np.argmax(gain, axis=1)
    return np.where(leaves & (gain[words, best] <= gain[words, mine] + 1e-9), of, best)


def turn(words: np.ndarray, step: int, parts: int) -> np.ndarray:
    """Whether each word (a number) may move in this step, about one in ``parts``."""
    mixed = (words.astype(np.uint64) + np.uint64(step << 32)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(32)) % np.uint64(parts) == 0


def numbered_tail(tail: DataFrame, known: int) -> DataFrame:
    """``word, n, number`` of the words without an entry in the dictionary; numbers go on from ``known``."""
    order = [F.col("n").desc(), F.col("word")]
    ranked = totals_before(tail.select("word", "n"), order, {"rank": F.lit(1)}, "lm-tail")
    return written(ranked.select("word", "n", (F.col("rank") + known).alias("number")), "lm-tail")


#: An entry's key: the word's number, then a neighbour's number and 1 if it comes after the word.
#: The largest neighbour number stands for the word's own count.
_OWN = (1 << 32) - 1
#: The end of a text, as a neighbour.
_END = (1 << 31) - 2


def _entries(left: np.ndarray, right: np.ndarray, e: int) -> np.ndarray:
    """Keys of the bigrams, under each of their words beyond the first ``e``; -1 (other words) and the end have none."""
    both = (left >= 0) & (right >= 0)
    left, right = left[both].astype(np.int64), right[both].astype(np.int64)
    a, b = (left >= e) & (left != _END), (right >= e) & (right != _END)
    return np.concatenate((left[a] << 32 | right[a] << 1 | 1, right[b] << 32 | left[b] << 1))


def _bytes_of(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Ragged rows of numbers, each as its bytes."""
    offsets = (starts * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _offsets(column: pa.Array) -> np.ndarray:
    """Where each row of lists or bytes starts, and the last one ends."""
    if not pa.types.is_binary(column.type) and not pa.types.is_large_binary(column.type):
        return np.asarray(column.offsets, dtype=np.int64)
    wide = column.cast(pa.large_binary())
    return np.frombuffer(wide.buffers()[1], dtype=np.int64)[wide.offset:wide.offset + len(wide) + 1]


def _numbers_of(column: pa.Array, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """What :func:`_bytes_of` took."""
    ends, data = _offsets(column), np.frombuffer(column.buffers()[2], dtype=np.uint8)
    return data[ends[0]:ends[-1]].view(dtype), (ends - ends[0]) // np.dtype(dtype).itemsize


#: Some of a word's entries: their codes as 4 bytes each, their times as 8.
ENTRIES = "word long, codes binary, times binary"


def _by_word(keys: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
    """Sorted entries as a row a word."""
    word = keys >> 32
    heads = np.flatnonzero(np.concatenate((word[:1] >= 0, word[1:] != word[:-1])))
    starts = np.append(heads, len(keys))
    return pa.RecordBatch.from_arrays(
        [pa.array(word[heads]), _bytes_of((keys & _OWN).astype("<u4"), starts), _bytes_of(times.astype("<i8"), starts)],
        names=["word", "codes", "times"])


def _counted(parts: Iterator[tuple[np.ndarray, np.ndarray | None]]) -> Iterator[pa.RecordBatch]:
    """Keys and their times (None: once each), counted some ``MOST_COUNTED`` at a time."""
    held, size = [], 0

    def flush():
        if all(times is None for _, times in held):
            return _by_word(*np.unique(np.concatenate([k for k, _ in held]), return_counts=True))
        keys = np.concatenate([k for k, _ in held])
        order = np.argsort(keys, kind="stable")
        return _by_word(*_summed_keys(keys[order], np.concatenate([t for _, t in held])[order]))

    for keys, times in parts:
        if len(keys):
            held.append((keys, times))
            size += len(keys)
        if size > MOST_COUNTED:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def neighbours(encoded: DataFrame, counts: np.ndarray, tail: DataFrame | None, e: int) -> DataFrame:
    """``word, n, codes, times`` of every word beyond the first ``e``, by number.

    ``codes`` has a neighbour's number doubled, plus 1 if it comes after the
    word; the end of a text has a number of its own.  Words seen once are no
    neighbours.  Each bigram is counted once in each task, then by word.
    """
    spark, k = encoded.sparkSession, len(counts)

    def of_ids(batches):
        def parts():
            for batch in batches:
                values, _ = _ids(batch)
                if len(values):
                    number = np.where(values < k, values, np.where(values == k, -1, _END)).astype(np.int64)
                    yield _entries(_before(number, _END), number, e), None

        return _counted(parts())

    def of_words(batches):
        for batch in batches:
            number, n = (batch.column(i).to_numpy().astype(np.int64) for i in range(2))
            order = np.argsort(number, kind="stable")
            yield _by_word(number[order] << 32 | _OWN, n[order])

    rows = encoded.select("ids").mapInArrow(of_ids, ENTRIES)
    if k > e:
        own = pa.table({"number": np.arange(e, k, dtype=np.int64), "n": counts[e:].astype(np.int64)})
        rows = rows.unionByName(spark.createDataFrame(own).mapInArrow(of_words, ENTRIES))  # KNOWN_WORDS rows at most
    if tail is not None:
        # words outside the dictionary, with the numbers beside them
        seen = encoded.select(F.explode("rare").alias("r")).select("r.word", "r.left", "r.right").join(
            tail.select("word", "number"), "word").select("number", "left", "right")

        def of_tail(batches):
            def parts():
                for batch in batches:
                    number, left, right = (batch.column(i).to_numpy().astype(np.int64) for i in range(3))
                    left, right = (np.where(x < k, x, np.where(x == k, -1, _END)) for x in (left, right))
                    yield np.concatenate((_entries(left, number, e), _entries(number, right, e))), None

            return _counted(parts())

        # two such words side by side: their pairs are joined with both numbers
        pairs = encoded.select("rare").mapInArrow(_beside, "a string, b string").groupBy("a", "b").agg(F.count(F.lit(1)).alias("times"))
        for side in ("a", "b"):
            pairs = pairs.join(tail.select(F.col("word").alias(side), F.col("number").alias(f"n{side}")), side)

        def of_pairs(batches):
            def parts():
                for batch in batches:
                    a, b, times = (batch.column(i).to_numpy().astype(np.int64) for i in range(3))
                    yield np.concatenate((a << 32 | b << 1 | 1, b << 32 | a << 1)), np.concatenate((times, times))

            return _counted(parts())

        rows = rows.unionByName(seen.mapInArrow(of_tail, ENTRIES)).unionByName(
            pairs.select("na", "nb", "times").mapInArrow(of_pairs, ENTRIES)).unionByName(
            tail.select("number", "n").mapInArrow(of_words, ENTRIES))

    def lists(batches):
        """Rows come sorted by word; a word's entries may go on in the next batch."""
        left_keys, left_times = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for part in _sliced(batches, 1, 4 * MOST_ENTRIES):
            codes, starts = _numbers_of(part.column(1), "<u4")
            keys = np.repeat(part.column(0).to_numpy(), np.diff(starts)) << 32 | codes
            keys, times = np.concatenate((left_keys, keys)), np.concatenate((left_times, _numbers_of(part.column(2), "<i8")[0]))
            order = np.argsort(keys, kind="stable")
            keys, times = _summed_keys(keys[order], times[order])
            done = int(np.searchsorted(keys, keys[-1] >> 32 << 32)) if len(keys) else 0
            left_keys, left_times = keys[done:], times[done:]
            if done:
                yield _word_rows(keys[:done], times[:done])
        if len(left_keys):
            yield _word_rows(left_keys, left_times)

    dealt = rows.repartition("word").sortWithinPartitions("word")
    return written(dealt.mapInArrow(lists, NEIGHBOURS), "lm-neighbours")


NEIGHBOURS = T.StructType([
    T.StructField("word", T.LongType(), False), T.StructField("n", T.LongType(), False),
    T.StructField("codes", T.ArrayType(T.LongType(), False), False), T.StructField("times", T.ArrayType(T.LongType(), False), False),
])


def _beside(batches):
    """Words outside the dictionary that stand side by side."""
    for batch in batches:
        lists = batch.column(0)
        offsets = np.asarray(lists.offsets)
        flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
        word, at = flat.field(0), np.asarray(flat.field(1))
        text = np.repeat(np.arange(len(lists)), np.diff(offsets))
        i = np.flatnonzero((at[1:] == at[:-1] + 1) & (text[1:] == text[:-1]))
        yield pa.RecordBatch.from_arrays([word.take(pa.array(i)), word.take(pa.array(i + 1))], names=["a", "b"])


def _summed_keys(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[heads], np.add.reduceat(times, heads)


def _word_rows(keys: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
    """Each word's own count comes last of its entries; no word is without it."""
    word, code = keys >> 32, keys & _OWN
    own = code == _OWN
    starts = starts_of(np.diff(np.flatnonzero(own), prepend=-1) - 1)
    lists = [
        pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(x[~own])).cast(pa.list_(pa.field("element", pa.int64(), False)))
        for x in (code, times)]
    return pa.RecordBatch.from_arrays([pa.array(word[own]), pa.array(times[own]), *lists], names=NEIGHBOURS.names)


def _table(batch: pa.RecordBatch, end: int) -> tuple[np.ndarray, ...]:
    """Words and their counts; the row, neighbour, side and times of each entry.

    Neighbours are the words below ``end``, and ``end`` for a text's end.
    """
    codes, offsets = _ids(batch, 2)
    times, _ = _ids(batch, 3)
    row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
    other = codes >> 1
    known = (other < end) | (other == _END)
    other = np.where(other == _END, end, other)[known]
    return batch.column(0).to_numpy(), batch.column(1).to_numpy(), row[known], other, codes[known] & 1, times[known]


def _sliced(batches, column: int = 2, most: int = MOST_ENTRIES):
    """Batches of whole rows with about ``most`` entries (bytes, if binary) in ``column``, or of one row."""
    for batch in batches:
        ends, at = _offsets(batch.column(column)) if batch.num_rows else [], 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


@dataclass
class State:
    """Classes of all numbered words and of the end, and the counts under them."""

    classes: np.ndarray  # bytes
    around: np.ndarray  # of the first words: classes before and after each, and itself after itself
    moves: np.ndarray  # class before x class
    sizes: np.ndarray
    raw: np.ndarray  # moves without those that have a word seen once

    def likelihood(self) -> float:
        return float(_h(self.moves).sum() - 2 * _h(self.sizes).sum())


def finished(raw: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``raw`` with the bigrams of words seen once: what is left of each class's tokens."""
    rare, moves = len(raw) - 2, raw.copy()
    others = np.arange(len(raw)) != rare
    moves[others, rare] += (sizes - moves.sum(axis=1))[others]
    moves[rare] += sizes - moves.sum(axis=0)
    return moves


def counted(near: DataFrame, of: np.ndarray, table: np.ndarray, counts: np.ndarray, tokens: int, texts: int) -> State:
    """The counts under the classes ``of`` the words and the end, from the neighbour table and the first words' bigrams ``table``."""
    e, width, end = len(table) - 2, int(of[-1]) + 1, len(of) - 1
    rare, slots = width - 2, 2 * width + 1
    held = near.sparkSession.sparkContext.broadcast(of)  # a byte a word, SWEPT_WORDS at most

    def add():
        def more(batch, totals):
            of = held.value
            for part in _sliced([batch]):
                word, n, row, other, after, times = _table(part, end)
                mine = of[word]
                cls, beside = mine[row].astype(np.int64), of[other].astype(np.int64)
                once = (after == 1) | (other < e) | (other == end)  # the others are under their other word
                cells = np.where(after == 1, cls * width + beside, beside * width + cls)[once]
                totals[:width * width] += np.bincount(cells, times[once], minlength=width * width).astype(np.int64)
                totals[width * width:width * width + width] += np.bincount(mine, n, minlength=width).astype(np.int64)
                first = other < e
                cells = other[first] * slots + np.where(after[first] == 1, 0, width) + cls[first]
                totals[-e * slots:] += np.bincount(cells, times[first], minlength=e * slots).astype(np.int64) if e else 0

        return more

    totals = summed(near, width * width + width + e * slots, add, "lm-around")
    raw, sizes = totals[:width * width].reshape(width, width), totals[width * width:width * width + width]
    around = totals[width * width + width:].reshape(e, slots)
    # the first words' and the ends' bigrams among themselves
    held_by = np.concatenate((of[:e], of[-1:])).astype(np.int64)
    inner = np.delete(np.delete(table, e, axis=0), e, axis=1)
    np.add.at(raw, (np.repeat(held_by, e + 1), np.tile(held_by, e + 1)), inner.ravel())
    member = np.zeros((e + 1, width), dtype=np.int64)
    member[np.arange(e + 1), held_by] = 1
    around[:, :width] += (inner.T @ member)[:e]
    around[:, width:2 * width] += (inner @ member)[:e]
    around[:, 2 * width] += np.diagonal(inner)[:e]
    np.add.at(sizes, of[:e], counts[:e])
    sizes[rare] += tokens - texts - sizes.sum()  # sizes has words only so far
    sizes[width - 1] = texts
    for lo in (0, width):
        around[:, lo + rare] += counts[:e] - around[:, lo:lo + width].sum(axis=1)
    return State(of, around, finished(raw, sizes), sizes, raw)


def _around(part: pa.RecordBatch, of: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, their counts, and the classes around each."""
    word, n, row, other, after, times = _table(part, len(of) - 1)
    slots, rare = 2 * width + 1, width - 2
    cells = row * slots + of[other] + np.where(after == 1, width, 0)
    around = np.bincount(cells, times, minlength=len(word) * slots)
    own = (other == word[row]) & (after == 1)
    around += np.bincount(row[own] * slots + 2 * width, times[own], minlength=len(around))
    around = around.astype(np.int64).reshape(len(word), slots)
    for lo in (0, width):
        around[:, lo + rare] += n - around[:, lo:lo + width].sum(axis=1)
    return word, n, around


def better_classes(near: DataFrame, state: State, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The words beyond the first ones that another class suits better, that class, and their tokens."""
    held = near.sparkSession.sparkContext.broadcast((state.classes, state.moves, state.sizes))

    def run(batches):
        of, table, sizes = held.value
        for part in _sliced(batches):
            word, n, around = _around(part, of, len(table))
            best = best_classes(table, sizes, around, n, of[word].astype(np.int64), len(table) - 2)
            to = best != of[word]
            if to.any():
                yield pa.RecordBatch.from_arrays([
                    pa.array([word[to].astype("<i4").tobytes()], pa.binary()), pa.array([best[to].astype(np.uint8).tobytes()], pa.binary()),
                    pa.array([int(n[to].sum())], pa.int64())], names=["words", "classes", "tokens"])

    # five bytes a word that would move, SWEPT_WORDS at most
    rows = near.mapInArrow(run, "words binary, classes binary, tokens long").toArrow()
    words, classes = (np.frombuffer(b"".join(rows.column(i).to_pylist()), dtype=d) for i, d in ((0, "<i4"), (1, np.uint8)))
    return words, classes, sum(rows.column(2).to_pylist())


def fit(encoded: DataFrame, counts: np.ndarray, tokens: int, types: int, texts: int, classes: int = CLASSES,
        exchange_words: int = EXCHANGE_WORDS) -> ClassModel:
    """The model of training rows ``ids``; ``counts`` of the numbered words, all ``tokens`` and ``types`` with the end's.

    All words outside the dictionary are in the class of the rare ones.
    """
    return fit_words(encoded, counts, None, tokens, types, texts, classes, exchange_words)[0]


def fit_words(encoded: DataFrame, counts: np.ndarray, tail: DataFrame | None, tokens: int, types: int, texts: int,
              classes: int = CLASSES, exchange_words: int = EXCHANGE_WORDS, swept: int = SWEPT_WORDS) -> tuple[ClassModel, DataFrame | None]:
    """The model and ``word, n, cls`` of the words of ``tail`` (``word, n``), which are not in the dictionary but have a class."""
    k = len(counts)
    e = min(exchange_words, k, swept)
    ids = encoded.select("ids")

    def bigrams():
        def more(batch, totals):
            values, _ = _ids(batch)
            small = np.minimum(values, e).astype(np.int64)
            small[values == k + 1] = e + 1
            totals += np.bincount(_before(small, e + 1) * (e + 2) + small, minlength=len(totals))

        return more

    table = summed(ids, (e + 2) ** 2, bigrams, "lm-bigrams").reshape(e + 2, e + 2)
    first = exchange(table, classes)
    c = int(first.max()) - 1  # exchange classes; then those of other words and of the end
    width = c + 2
    if width > 256:
        raise ValueError("254 classes at most")
    tail = None if tail is None else numbered_tail(tail, k)
    n_words = k + (0 if tail is None else tail.count())
    table_of_neighbours = near = neighbours(encoded, counts, tail, e)
    beyond = near.where(F.col("word") >= swept) if n_words > swept else None
    near = near.where(F.col("word") < swept) if n_words > swept else near
    start = np.concatenate((first[:e], np.full(min(n_words, swept) - e, c), [c + 1])).astype(np.uint8)
    state = settled(near, start, table, counts, tokens, texts)
    of, sizes, raw = state.classes, state.sizes, state.raw
    far = None
    if beyond is not None:
        far, sizes, raw = joined_last(beyond, state)
    share = (sizes + 1) / (sizes.sum() + width)
    moves = (finished(raw, sizes) + TRANSITION_MASS * share) / (finished(raw, sizes).sum(axis=1, keepdims=True) + TRANSITION_MASS)
    rare_types, rare_tokens = types - n_words - (texts > 0), int(sizes[c])  # no word of a choice is left in that class
    known = np.full(k + 2, c, dtype=np.int64)
    known[:min(k, swept)], known[-1] = of[:min(k, swept)], c + 1
    if far is not None and k > swept:  # the dictionary holds words beyond the sweeps
        for r in far.where(F.col("number") < k).collect():
            known[r["number"]] = r["cls"]
    model = ClassModel(
        known, np.log10(moves), sizes,
        np.concatenate((np.log10(counts / np.maximum(1, sizes[known[:k]])), [0.0, 0.0])),
        np.concatenate((np.log10((counts + 1) / (tokens + types + 1)), -np.log10([tokens + types + 1.0]),
                        np.log10([(texts + 1) / (tokens + types + 1)]))),
        tokens, types, rare_tokens + RARE_MASS * (rare_types + 1),
    )
    classed = None if tail is None else _classed(tail, of, far)
    if beyond is None:  # the last of the sweeps is done
        dropped(table_of_neighbours)
    return model, classed


def _classed(tail: DataFrame, of: np.ndarray, far: DataFrame | None) -> DataFrame:
    """``word, n, cls`` of ``tail``."""
    held = tail.sparkSession.sparkContext.broadcast(of)
    schema = "word string, n long, cls int"

    def run(batches):
        for batch in batches:
            cls = held.value[batch.column(2).to_numpy()].astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cls)], names=["word", "n", "cls"])

    near = tail.where(F.col("number") < len(of) - 1).select("word", "n", "number").mapInArrow(run, schema)
    return near if far is None else near.unionByName(tail.join(far, "number").select("word", "n", "cls"))


def joined_last(beyond: DataFrame, state: State) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """``number, cls`` of the words that took part in no sweep, and the sizes and raw moves with them.

    Until then they count as words seen once.
    """
    held, width = beyond.sparkSession.sparkContext.broadcast((state.classes, state.moves, state.sizes)), len(state.moves)

    def run(batches):
        of, table, sizes = held.value
        for part in _sliced(batches):
            word, n, around = _around(part, of, width)
            best = best_classes(table, sizes, around, n, np.full(len(word), width - 2), width - 2)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(best.astype(np.int32)), *part.columns[1:]], names=names)

    names = ["word", "cls", "n", "codes", "times"]
    chosen = written(beyond.mapInArrow(run, "word long, cls int, n long, codes array<bigint>, times array<bigint>"), "lm-beyond")

    def add():
        def more(batch, totals):
            of = held.value[0]
            n, row, other, after, times = _table(batch.select([0, 2, 3, 4]), len(of) - 1)[1:]
            cls = batch.column(1).to_numpy().astype(np.int64)
            mine, beside = cls[row], of[other].astype(np.int64)
            cells = np.where(after == 1, mine * width + beside, beside * width + mine)
            totals[:width * width] += np.bincount(cells, times, minlength=width * width).astype(np.int64)
            totals[width * width:] += np.bincount(cls, n, minlength=width).astype(np.int64)

        return more

    totals = summed(chosen, width * width + width, add, "lm-beyond")
    raw, more = state.raw + totals[:width * width].reshape(width, width), totals[width * width:]
    # bigrams of two such words: under the first of them
    entry, other = F.col("e"), F.shiftright("e.codes", 1)
    pairs = chosen.select("cls", F.explode(F.arrays_zip("codes", "times")).alias("e")).where(
        (entry["codes"] % 2 == 1) & (other >= len(state.classes) - 1) & (other != _END)).select(
        "cls", other.alias("word"), entry["times"].alias("times"))
    pairs = pairs.join(chosen.select("word", F.col("cls").alias("to")), "word").groupBy("cls", "to").agg(F.sum("times").alias("n"))
    for r in pairs.collect():  # a row two classes
        raw[r["cls"], r["to"]] += r["n"]
    sizes = state.sizes + more
    sizes[width - 2] -= more.sum()
    return chosen.select(F.col("word").alias("number"), "cls"), sizes, raw


def exchanged_first(state: State, table: np.ndarray, counts: np.ndarray) -> State:
    """The state after exchange of the first words, of the bigrams ``table``, among all words, the others of which stay.

    All words have classes.  The exchange keeps the counts exactly, so nothing is counted anew.
    """
    e, width = len(table) - 2, len(state.moves)
    around = state.around.astype(float)
    of = np.concatenate((state.classes[:e], [width - 2, width - 1])).astype(np.int64)
    ends = np.zeros((2, width))  # the last two never move
    ahead, after = (np.concatenate((around[:, lo:lo + width], ends)) for lo in (0, width))
    moves, first, second = state.moves.astype(float), state.sizes.astype(float), state.sizes.astype(float)
    times = np.concatenate((counts[:e], [0, 0])).astype(float)
    of = exchanged(table.astype(float), of, after, ahead, moves, first, second, times, times, width - 2, SWEEPS)
    classes, moves = state.classes.copy(), moves.astype(np.int64)
    classes[:e] = of[:e]
    raw = moves.copy()
    raw[width - 2] = raw[:, width - 2] = 0  # words seen once only
    around = np.concatenate((ahead[:e], after[:e], around[:, 2 * width:]), axis=1).astype(np.int64)
    return State(classes, around, moves, first.astype(np.int64), raw)


def settled(near: DataFrame, start: np.ndarray, table: np.ndarray, counts: np.ndarray, tokens: int, texts: int) -> State:
    """Sweeps over all words from the classes ``start``: count, and move each word to its best class.

    The first words, those of the bigrams ``table``, move one by one among all
    others; then the others move at once, on the counts after that.  A move
    that loses likelihood is not kept; after one of the others, half as many
    of them move at a time.  The sweeps end when another class suits the words
    of less than ``FEW_MOVES`` of the tokens, when a sweep gains less than
    ``LEAST_GAIN`` a token that may move, or when even ``MOST_PARTS`` parts lose.
    """
    best, step, parts = counted(near, start, table, counts, tokens, texts), 0, 1
    e, rare = len(table) - 2, int(start[-1]) - 1
    if (start == rare).any():  # first, every word gets a class
        words, classes, _ = better_classes(near, best, counts)
        of = best.classes.copy()
        of[words] = classes
        best = counted(near, of, table, counts, tokens, texts)
    while True:
        before, state = best.likelihood(), exchanged_first(best, table, counts)
        wish = int(counts[:e][state.classes[:e] != best.classes[:e]].sum())
        best = state if state.likelihood() > before else best
        words, classes, tokens_of = better_classes(near, best, counts)
        wish += tokens_of
        if not wish or wish < FEW_MOVES * tokens:
            return best
        while len(words):
            now = turn(words, step, parts)
            step += 1
            of = best.classes.copy()
            of[words[now]] = classes[now]
            state = counted(near, of, table, counts, tokens, texts)
            if state.likelihood() > best.likelihood():
                best = state
                break
            parts *= 2
            if parts > MOST_PARTS:
                return best
        if best.likelihood() - before < LEAST_GAIN * tokens / parts:
            return best


def lm_scores(
    docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", known_most: int = KNOWN_WORDS,
    classes: int = CLASSES, exchange_words: int = EXCHANGE_WORDS, swept: int = SWEPT_WORDS,
) -> DataFrame:
    """Scores of every text under the model of the rows for which ``train`` (of ``id_col``) holds.

    ``id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    perplexity``.  A text's tokens are its lower-cased words and one end; a
    null text is empty.  ``base_score``: add-one unigram; ``score``: the class
    model's log10 probability.  Without training rows both are the
    probabilities of a model that has seen nothing.  Rows may repeat.
    ``known_most`` words at most are in the tasks' dictionary; the others are
    joined, with the same result.  ``swept`` words at most take part in the
    sweeps; any others join the classes that these have settled.  Empty tables
    stay empty.  Only the two named columns are read.
    """
    rows = docs.select(F.col(id_col).alias("id"), (~train).alias("held_out"), F.col(text_col).alias("text"))
    vocabulary = written(count_words(rows.where("not held_out"), "text"), "lm-words")
    sums = vocabulary.agg(
        F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("types"), F.max(F.when(F.col("word") == END, F.col("n"))).alias("texts")
    ).first()
    tokens, types, texts = sums["tokens"] or 0, sums["types"], sums["texts"] or 0
    words, counts, first_step = known_words(vocabulary, known_most)
    encoded = with_row_ids(encode(rows, "text", words), "lm-ids")
    others = vocabulary.where((F.col("word") != END) & (_step(F.col("n")) < first_step))
    tail = others.where("n > 1")
    model, classed = fit_words(
        encoded.where("not held_out"), counts, tail if tail.limit(1).count() else None, tokens, types, texts, classes, exchange_words,
        swept)
    k, rare = len(words), len(model.moves) - 2
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        for batch in batches:
            values, offsets = _ids(batch, 3)
            before, numbered = _before(values, k + 1), values != k
            moves = np.where(numbered & (before != k), m.moves[m.classes[before], m.classes[values]], 0.0)  # the others' are joined
            names = ["id", "held_out", ROW, "n_tokens", "known", "rare_tokens", "base", "model"]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), batch.column(2), pa.array(np.diff(offsets)),
                pa.array(sums_of((values < k).astype(np.int64), offsets) + m.seen_end),
                pa.array(sums_of((values == k).astype(np.int64), offsets)),
                pa.array(_float_sums(m.unigram[values], offsets)),
                pa.array(_float_sums(moves + m.emits[values], offsets)),
            ], names=names)

    schema = T.StructType([
        encoded.schema["id"], encoded.schema["held_out"], encoded.schema[ROW], T.StructField("n_tokens", T.LongType()),
        T.StructField("known", T.LongType()), T.StructField("rare_tokens", T.LongType()),
        T.StructField("base", T.DoubleType()), T.StructField("model", T.DoubleType()),
    ])
    scored = encoded.select("id", "held_out", ROW, "ids").mapInArrow(run, schema)
    places = encoded.select(ROW, F.explode("rare").alias("r")).select(ROW, "r.*")
    if classed is not None:
        others = written(classed.unionByName(others.where("n = 1").withColumn("cls", F.lit(rare))), "lm-others")
    else:
        others = others.withColumn("cls", F.lit(rare))
    found = places.join(others, "word", "left").select(
        ROW, "at", "left", "right", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("cls", F.lit(rare)).alias("cls"))
    # a text's words without a number come together, as they do in its own row
    beside = found.groupBy(ROW).agg(F.array_sort(F.collect_list(F.struct("at", "left", "right", "n", "cls"))).alias("r"))

    def joined(batches):
        m = held.value
        for batch in batches:
            lists = batch.column(1)
            offsets = np.asarray(lists.offsets, dtype=np.int64)
            flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
            at, left, right, n, cls = (np.asarray(flat.field(i)) for i in range(5))
            offsets = offsets - offsets[0]
            # a neighbour without a number is the entry before or after
            before = np.where(left == k, np.concatenate(([0], cls[:-1])), m.classes[left])
            moves = m.moves[before, cls] + np.where(right == k, 0.0, m.moves[cls, m.classes[right]])
            rare_word = cls == len(m.moves) - 2
            emits = np.where(rare_word, np.log10((n + RARE_MASS) / m.rare_total), np.log10(np.maximum(n, 1) / np.maximum(1, m.sizes[cls])))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(sums_of((n > 0).astype(np.int64), offsets)),
                pa.array(_float_sums(np.log10(n + 1), offsets)), pa.array(_float_sums(moves + emits, offsets)),
            ], names=[ROW, "rare_known", "rare_base", "rare_model"])

    beside = beside.mapInArrow(joined, f"{ROW} long, rare_known long, rare_base double, rare_model double")
    zero = F.lit(0.0)
    both = scored.join(beside, ROW, "left")
    score = F.col("model") + F.coalesce("rare_model", zero)
    return both.select(
        "id", "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("rare_base", zero)).alias("base_score"),
        score.alias("score"), F.pow(F.lit(10.0), -score / F.col("n_tokens")).alias("perplexity"),
    )


def _float_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ragged rows of at least one value; no running total over the batch, so no loss of digits."""
    return np.add.reduceat(values, offsets[:-1]) if len(offsets) > 1 else np.zeros(0)
