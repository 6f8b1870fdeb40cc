"""Arrow batches of texts inside tasks: words, bounded pieces, appended columns.

Spark partitions the rows; these helpers only work on the batch at hand, in
pieces of a bounded number of text bytes (a single longer text is a piece of
its own).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

PIECE_BYTES = 8 << 20


class Numbers(dict):
    """Numbers its keys 0, 1, ... in the order in which they are first looked up."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


PIECE_ROWS = 8192


def pieces(batch: pa.RecordBatch, text: int, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of ``PIECE_ROWS`` rows and ``most`` bytes in column ``text`` at most,
    or of one row."""
    if batch.num_rows == 0:
        return
    sizes = batch.column(text).cast(pa.large_binary())
    ends = np.frombuffer(sizes.buffers()[1], dtype=np.int64)[sizes.offset: sizes.offset + len(sizes) + 1]
    at = 0
    while at < len(sizes):
        to = int(np.searchsorted(ends, ends[at] + most, side="right")) - 1
        to = min(max(to, at + 1), at + PIECE_ROWS, len(sizes))
        yield batch.slice(at, to - at)
        at = to


def utf8(texts: pa.Array, lower: bool = False) -> list[bytes]:
    """The texts as UTF-8 bytes; null is empty; ``lower`` maps A-Z only."""
    out = [t or b"" for t in texts.cast(pa.binary()).to_pylist()]
    return [t.lower() for t in out] if lower else out


def words_of(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """All words (runs of bytes other than 0x20, 0x09-0x0D) of the texts, and each text's count."""
    each = [t.split() for t in texts]
    counts = np.fromiter(map(len, each), dtype=np.int64, count=len(each))
    return list(chain.from_iterable(each)), counts


def numbered_words(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different words of the texts, the place among them of every word in a row, and each text's count.

    The words are those of :func:`words_of`; ``lower`` maps A-Z only.
    """
    lists = pc.ascii_split_whitespace(texts.fill_null(""))
    flat = lists.flatten().dictionary_encode()
    different, at = flat.dictionary, flat.indices.to_numpy()
    if lower:
        lowered = pc.ascii_lower(different).dictionary_encode()
        different, at = lowered.dictionary, lowered.indices.to_numpy()[at]
    starts = lists.offsets.to_numpy().astype(np.int64)
    empty = pc.index(different, "").as_py()  # beside white space at either end of a text
    if empty >= 0:
        some = at != empty
        starts = starts_of(some)[starts]
        at = at[some] - (at[some] > empty)
        different = different.filter(pc.not_equal(different, ""))
    return different, at, np.diff(starts)


def bytes_of(words: pa.Array) -> list[bytes]:
    """Many short texts without nulls as UTF-8 bytes, several times faster than :func:`utf8`."""
    return words.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()


def starts_of(counts: np.ndarray) -> np.ndarray:
    """Offsets of ragged rows: ``len(counts) + 1`` entries from 0."""
    return np.concatenate(([0], np.cumsum(counts))).astype(np.int64)


def sums_of(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of each ragged row of ``values``."""
    total = np.concatenate((np.zeros(1, dtype=np.result_type(values, np.int64)), np.cumsum(values)))
    return total[starts[1:]] - total[starts[:-1]]


def annotate(
    df: DataFrame, text_col: str, into: str, fields: T.StructType,
    make: Callable[[], Callable[[pa.Array], dict[str, pa.Array]]], most: int = PIECE_BYTES,
) -> DataFrame:
    """``df`` with a struct column ``into`` computed from its texts.

    ``make`` runs once in each task and gives the function that maps an array
    of texts, of ``most`` bytes together or one text, to the struct's columns.  All other columns pass through, so rows
    need no key and may repeat; extra columns may have any name but ``into``.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(into, fields, False)])
    at = df.columns.index(text_col)

    def run(batches):
        work = make()
        for batch in batches:
            for piece in pieces(batch, at, most):
                got = work(piece.column(at))
                columns = [got[f.name] for f in fields]
                struct = pa.StructArray.from_arrays(columns, names=[f.name for f in fields])
                yield pa.RecordBatch.from_arrays([*piece.columns, struct], names=[*piece.schema.names, into])

    return df.mapInArrow(run, schema)


def byte_symbols() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, then from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
