"""Token-ID output: Parquet files of whole documents in id order.

Spark deals the documents out by id range; each task tokenises its range and
writes one file, sorted by document id.  ``ids`` is a list column with
dictionary pages, the metadata columns are delta-encoded; row groups and pages
have set sizes, and the page indexes let a reader skip to the ids and columns
that it asks for.  Each row has its offset within its file, so a document's
place in the whole corpus needs one total a file.
"""

from __future__ import annotations

import json
import os
import unicodedata
import zlib
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfold.llm.bpe import same_as_ranks
from riskfold.llm.text import byte_symbols, bytes_of, numbered_words, pieces, starts_of, sums_of

END_ID = 1
#: Written in row groups and pages of these sizes.
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2_000
#: A worker keeps the ids of so many different words, those that most pieces had; it drops the others when it
#: holds two and a half times as many.
MOST_WORDS = 150_000
PIECE_BYTES = 4 << 20

FILE = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("offset", T.LongType(), False),
    T.StructField("n_tokens", T.LongType(), False),
    T.StructField("ids", T.ArrayType(T.IntegerType(), False), False),
])

#: Kinds of words for the encoder besides the number of their parts.
_ALONE, _MARKED = -1, 0
#: Letters below this code point are lower-cased one by one, here as in the tokenizer; nor does normalising join any.
_LATIN_END = 0x250
#: Added to the number of parts of words with other letters.
_OTHER = 2

_MARKS = ".,;:!?"
#: What a character can be to a word's kind.
_LETTER, _MARK, _ZERO, _NO_LETTER, _BEYOND = 1, 2, 4, 8, 16


def _flag(c: str) -> int:
    if c == "\n":
        return 0  # between two words
    if c.isalpha() and c.lower().isalpha():
        return _LETTER
    return _MARK if c in _MARKS else _ZERO if c == "0" else _NO_LETTER


_FLAGS = np.array([*map(_flag, map(chr, range(_LATIN_END))), _BEYOND], dtype=np.uint8)


def _parts(word: str) -> int:
    """1 or 2 for letters and letters with a mark after them, which stay so when normalised, ``_OTHER`` more if these
    are not all Latin; else a kind."""
    if word.isalpha():
        n = 1
    elif word[-1] in _MARKS and word[:-1].isalpha():
        n = 2
    else:
        return _ALONE if "0" in word else _MARKED
    if word.isascii():
        return n
    if unicodedata.is_normalized("NFC", word) and word.lower()[: None if n == 1 else -1].isalpha():
        return n if ord(max(word)) < _LATIN_END else n + _OTHER
    return _MARKED


def _kinds(codes: np.ndarray, ends: np.ndarray, plain: list[str]) -> np.ndarray:
    """:func:`_parts` of the words ``plain``, each of which ends before one of ``ends`` in the code points ``codes``."""
    flags = _FLAGS[np.minimum(codes, _LATIN_END)]
    starts, last = np.concatenate(([0], ends[:-1] + 1)), flags[ends - 1]
    flags[ends - 1] = 0
    body = np.bitwise_or.reduceat(flags, starts)
    both = body | last
    kinds = np.where(both & _ZERO, _ALONE, _MARKED)
    kinds[both == _LETTER] = 1
    kinds[(body == _LETTER) & (last == _MARK)] = 2
    beyond = np.flatnonzero(both & _BEYOND)
    kinds[beyond] = [_parts(plain[i]) for i in beyond.tolist()]
    return kinds


_ENCODERS: dict[str, "WordEncoder"] = {}


class WordEncoder:
    """Encodes texts word by word, each different word once.

    The tokenizer drops white space and no token spans it, its normaliser does
    not join characters across it, and none of its special strings holds any;
    so a text's ids are its words' ids in a row.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.numbers: dict[bytes, int] = {}
        self.ids = np.zeros(0, dtype=np.int32)
        self.starts = np.zeros(1, dtype=np.int64)
        self.uses = np.zeros(0, dtype=np.int64)
        (self._mark,) = self.tokenizer.encode("0", add_special_tokens=False).ids
        vocabulary = self.tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self._ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        if max(vocabulary.values()) < 1 << 16:
            self.ids = self.ids.astype(np.uint16)
        self._ranked = self._by_rank(path)

    @staticmethod
    def _by_rank(path: str):
        """The same merges in tiktoken, which is several times faster; a word ends with a zero byte there."""
        import tiktoken

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        symbols = byte_symbols()

        def plain(token: str) -> bytes:
            end = token.endswith("</w>")
            return bytes(symbols[c] for c in token.removesuffix("</w>")) + b"\0" * end

        ranks = {plain(t): i for t, i in model["vocab"].items() if not t.startswith("<|")}
        # a word's last character is one symbol with its end
        ends = [(bytes([b]), b"\0") for b in sorted(range(256), key=lambda b: ranks[bytes([b, 0])])]
        rules = [tuple(map(plain, m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
        if not same_as_ranks(ranks, ends + rules):
            return None
        return tiktoken.Encoding("words", pat_str="[^\0]+\0", mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def of(cls, path: str) -> "WordEncoder":
        """One encoder a worker process, which later tasks use again."""
        if path not in _ENCODERS:
            _ENCODERS[path] = cls(path)
        return _ENCODERS[path]

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and the number of each word.

        Words of letters alone, or of letters and one mark after them, go in
        one call: the tokenizer makes one or two parts of them, and the last id
        of each part is one that ends a part.  Latin ones go straight to the
        merges, past normaliser and splitter.  All other words go with the
        word ``0`` after each, whose single id marks the ends, or one by one
        if they hold this digit.
        """
        text = b"\n".join([*words, b""]).decode()
        plain, codes = text.split("\n")[:-1], np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
        ends = np.flatnonzero(codes == ord("\n"))
        kinds = _kinds(codes, ends, plain)
        groups = np.searchsorted([_MARKED, 1, 1 + _OTHER], kinds, side="right")
        order = np.argsort(groups, kind="stable")
        alone, marked, latin, parted = np.split(order, np.searchsorted(groups[order], [1, 2, 3]))
        word_of = [[plain[i] for i in g.tolist()] for g in (alone, marked, parted)]
        got = [self._alone(word_of[0]), self._marked(word_of[1]), self._latin(codes, ends, latin, kinds),
               self._parted(word_of[2], kinds[parted] - _OTHER)]
        flat, n = np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])
        # back to the words' own order
        counts, begin = np.empty(len(plain), dtype=np.int64), np.empty(len(plain), dtype=np.int64)
        counts[order], begin[order] = n, starts_of(n)[:-1]
        at = np.repeat(begin - starts_of(counts)[:-1], counts) + np.arange(counts.sum())
        return flat[at], counts

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.int32)

    def _alone(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        each = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return np.array([x for e in each for x in e], dtype=np.int32), np.array([len(e) for e in each], dtype=np.int64)

    def _marked(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = self._ids("".join(f"{w}\n0\n" for w in words))
        ends = np.flatnonzero(got == self._mark)
        if len(ends) != len(words):
            raise ValueError("the tokenizer does not give each word 0 its own id")
        return got[got != self._mark], np.diff(ends, prepend=-1) - 1

    def _latin(self, codes: np.ndarray, ends: np.ndarray, at: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words ``at``, in ascending order; a zero ends each part."""
        mine = np.zeros(len(ends), dtype=bool)
        mine[at] = True
        letters = codes[np.repeat(mine, np.diff(ends, prepend=-1))]
        between, parts = np.flatnonzero(letters == ord("\n")), kinds[at]
        if self._ranked is None:
            return self._parted(letters.tobytes().decode("utf-32-le").split("\n")[:-1], parts)
        split = np.where(letters == ord("\n"), 0, letters).astype("<u4")
        text = np.insert(split, between[parts == 2] - 1, 0).tobytes().decode("utf-32-le").lower()
        return self._ended(self._ranked.encode_to_numpy(text, disallowed_special=()).astype(np.int32), parts)

    def _parted(self, words: list[str], parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self._ended(self._ids("\n".join(words)), parts)

    def _ended(self, got: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``got`` and the number of each word, which has so many ids that end a part."""
        ends = np.flatnonzero(self._ends[got])
        if len(ends) != parts.sum():
            raise ValueError("the tokenizer does not make one part of letters and one of marks")
        last = ends[np.cumsum(parts) - 1] if len(parts) else ends
        return got, np.diff(last, prepend=-1)

    def __call__(self, texts: pa.Array | list[bytes], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, each text's with ``end_id``, and the number of each text.

        The piece's different words are looked up once each.
        """
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.binary()).cast(pa.string())
        different, words, counts = numbered_words(texts)
        each, known = bytes_of(different), len(self.numbers)
        at = np.fromiter(map(self.numbers.get, each, repeat(-1)), dtype=np.int64, count=len(each))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new = [each[i] for i in missing.tolist()]
            at[missing] = np.arange(known, known + len(new))
            self.numbers.update(zip(new, range(known, known + len(new))))
            ids, n = self._encode(new)
            self.ids = np.concatenate((self.ids, ids.astype(self.ids.dtype)))
            self.uses = np.concatenate((self.uses, np.zeros(len(n), dtype=np.int64)))
            self.starts = np.concatenate((self.starts, self.starts[-1] + np.cumsum(n)))
        self.uses[at] += 1
        # the piece's own words; the end id is one more, after each text's last
        starts = self.starts[at]
        lengths = np.append(self.starts[at + 1] - starts, 1)
        first = starts_of(lengths)
        ids = np.append(self.ids[np.repeat(starts - first[:-2], lengths[:-1]) + np.arange(first[-2])].astype(np.int32), np.int32(end_id))
        words = np.insert(words, np.cumsum(counts), len(each))
        lengths, begin = lengths[words], first[words]
        place = starts_of(lengths)
        out = ids[np.repeat(begin - place[:-1], lengths) + np.arange(place[-1])]
        n = sums_of(lengths, starts_of(counts + 1))
        if len(self.numbers) > MOST_WORDS * 5 // 2:
            self._keep(np.sort(np.argsort(-self.uses, kind="stable")[:MOST_WORDS]))
        return out, n

    def _keep(self, kept: np.ndarray) -> None:
        """Drop all words but those numbered ``kept``."""
        words, counts = list(self.numbers), np.diff(self.starts)[kept]
        first = starts_of(counts)
        self.ids = self.ids[np.repeat(self.starts[kept] - first[:-1], counts) + np.arange(first[-1])]
        self.starts, self.uses = first, self.uses[kept]
        self.numbers = dict(zip(map(words.__getitem__, kept.tolist()), range(len(kept))))


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
) -> None:
    """Write the ids of every whole text, with ``end_id`` after each, in ascending id order.

    A null id sorts first, a null text is empty; rows that repeat an id are
    ordered by a hash of their text, then by the text.  ``tokenizer`` is a
    tokenizer file that all machines have.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")

    def run(batches):
        encode, before = WordEncoder.of(tokenizer), 0
        for batch in batches:
            for part in pieces(batch, 1, PIECE_BYTES):
                ids, n = encode(part.column(1), end_id)
                ends = starts_of(n)
                lists = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(ids)).cast(
                    pa.list_(pa.field("element", pa.int32(), False)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(before + ends[:-1]), pa.array(n), lists], names=FILE.names)
                before += int(ends[-1])

    ranged.mapInArrow(run, FILE).write.options(**{
        "compression": "zstd", "parquet.block.size": ROW_GROUP_BYTES, "parquet.page.size": PAGE_BYTES,
        "parquet.page.row.count.limit": PAGE_ROWS, "parquet.writer.version": "v2",
        # few different values, many times: dictionary; rising or small numbers: delta
        "parquet.enable.dictionary": "false", "parquet.enable.dictionary#ids.list.element": "true",
    }).parquet(path)


def _file_number() -> Column:
    return F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("long")


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens`` of each document: the ids' pages are not read."""
    return _with_starts(spark, path).drop("ids", "part")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids``; a filter on ``doc_id`` reaches the page indexes."""
    return _with_starts(spark, path).drop("part")


def _with_starts(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.schema(FILE).parquet(path).withColumn("part", _file_number())
    totals = files.groupBy("part").agg(F.max(F.col("offset") + F.col("n_tokens")).alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return files.join(F.broadcast(bases), "part").select(  # one row a file
        "doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids", "part"
    )


def with_checksums(tokens: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32``, counted and summed over the ids read.

    CRC-32 of the ids as little-endian unsigned 32-bit integers.
    """
    schema = T.StructType([
        *[tokens.schema[c] for c in ("doc_id", "start")],
        T.StructField("n_tokens", T.LongType(), False), T.StructField("ids_crc32", T.LongType(), False),
    ])

    def run(batches):
        for batch in batches:
            lists = batch.column(2)
            ends = np.asarray(lists.offsets, dtype=np.int64)
            raw = memoryview(np.ascontiguousarray(np.asarray(lists.values), dtype="<i4")).cast("B")
            sums = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(ends)), pa.array(sums, pa.int64())], names=schema.names)

    return tokens.select("doc_id", "start", "ids").mapInArrow(run, schema)
