"""Benchmark decontamination with one Aho-Corasick automaton.

The windows of the benchmark items (ten consecutive normalised words; a
shorter item is one window) are the patterns.  Each text is normalised to
``" w1 w2 ... "`` and scanned once; a match gives word positions, which map
back to offsets in the original text.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfold.llm.text import annotate, utf8

WINDOW = 10
#: Patterns of at most this many characters make one automaton; more go to
#: further automata, which scan the texts in turn.
BLOCK_CHARS = 64 << 20

#: A-Z become a-z; bytes 00-2F, 3A-60 (after lower-casing) and 7B-7F become spaces.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else 32 if b < 48 or 58 <= b <= 96 or 123 <= b <= 127 else b for b in range(256)
)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

RESULT = T.StructType([
    T.StructField("n_words", T.LongType(), False),
    T.StructField("n_hit", T.LongType(), False),
    T.StructField("items", T.ArrayType(T.StringType(), False), False),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType(), False), T.StructField("end", T.LongType(), False),
    ]), False), False),
])


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def item_windows(text: str | None, size: int = WINDOW) -> list[str]:
    """The patterns of one item, each between spaces."""
    words = [w.decode() for w in normal_words((text or "").encode())]
    if not words:
        return []
    return [f" {' '.join(words[i:i + size])} " for i in range(max(1, len(words) - size + 1))]


def blocks_of(items: DataFrame, id_col: str, text_col: str, size: int, most: int) -> list[dict[str, list[str]]]:
    """The stated benchmark as blocks of ``pattern: item ids``, each of a checked size.

    Items arrive one partition at a time; what the driver holds are the
    benchmark's patterns, which the tasks need whole.
    """
    blocks: list[dict[str, list[str]]] = []
    chars = most
    rows = items.select(F.col(id_col).cast("string"), F.col(text_col)).toLocalIterator()
    for item, text in rows:
        for p in item_windows(text, size):
            if chars + len(p) > most and (not blocks or p not in blocks[-1]):
                blocks.append({})
                chars = 0
            ids = blocks[-1].setdefault(p, [])
            chars += len(p) if not ids else 0
            if (item or "") not in ids:
                ids.append(item or "")
    return blocks


def _scanner(patterns: dict[str, list[str]]):
    """Work for :func:`annotate`: words, hit words, items and original offsets of each text."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for p, ids in patterns.items():
        automaton.add_word(p, (p.count(" ") - 1, ids))
    if patterns:
        automaton.make_automaton()

    def scan(text: bytes):
        words = normal_words(text)
        if not words or not patterns:
            return len(words), 0, [], []
        normal = f" {b' '.join(words).decode()} "
        found, hits, at, seen = set(), [], 0, 0
        for end, (n, ids) in automaton.iter(normal):
            seen += normal.count(" ", at, end)  # spaces before the closing one = words up to it
            at = end
            hits.append((seen - n, seen))
            found.update(ids)
        if not hits:
            return len(words), 0, [], []
        hit = np.zeros(len(words) + 2, dtype=np.int64)
        for lo, hi in hits:
            hit[lo + 1] += 1
            hit[hi + 1] -= 1
        inside = np.concatenate(([False], np.cumsum(hit)[1:-1] > 0, [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        places = [m.span() for m in _WORD.finditer(text)]
        # offsets in characters of the original text
        spans = [
            (len(text[: places[a][0]].decode()), len(text[: places[b - 1][1]].decode()))
            for a, b in zip(edges[::2], edges[1::2])
        ]
        return len(words), int(inside.sum()), sorted(found), spans

    def work(texts: pa.Array) -> dict[str, pa.Array]:
        n, hit, items, spans = zip(*map(scan, utf8(texts)))
        return {
            "n_words": pa.array(n, pa.int64()), "n_hit": pa.array(hit, pa.int64()),
            "items": pa.array(items, pa.list_(pa.field("element", pa.string(), False))),
            "spans": pa.array(
                [[{"start": a, "end": b} for a, b in s] for s in spans],
                pa.list_(pa.field("element", pa.struct([
                    pa.field("start", pa.int64(), False), pa.field("end", pa.int64(), False)]), False)),
            ),
        }

    return work


def decontaminate(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
    into: str = "__leak", size: int = WINDOW, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``docs`` with a struct ``into`` of ``n_words, n_hit, items, spans``.

    ``n_hit``: words inside any occurrence of a window; ``items``: ids (text,
    sorted) of the items with occurring windows; ``spans``: character offsets
    in the original text of the runs of hit words.  Null and empty texts have
    no words; items without words match nothing; items that repeat count once
    an id, a null id is the empty id.  Needs no shuffle, and rows may repeat.

    A benchmark over ``block_chars`` characters of patterns is scanned in
    blocks of that size, one after the other; the hit words of all blocks are
    united.
    """
    spark = docs.sparkSession
    out = docs
    blocks = blocks_of(items, item_id, item_text, size, block_chars) or [{}]
    for i, block in enumerate(blocks):
        held = spark.sparkContext.broadcast(block)  # of at most block_chars characters
        out = annotate(out, text_col, f"{into}{i}" if len(blocks) > 1 else into, RESULT, lambda held=held: _scanner(held.value))
    if len(blocks) > 1:
        out = _united(out, docs.columns, text_col, into, len(blocks))
    return out


def _united(df: DataFrame, columns: list[str], text_col: str, into: str, n: int) -> DataFrame:
    """The results of ``n`` blocks as one: spans are united and their words counted again."""
    parts = [f"{into}{i}" for i in range(n)]
    schema = T.StructType([*[df.schema[c] for c in columns], T.StructField(into, RESULT, False)])

    def run(batches):
        for batch in batches:
            texts = utf8(batch.column(batch.schema.get_field_index(text_col)))
            results = [batch.column(batch.schema.get_field_index(p)).to_pylist() for p in parts]
            rows = []
            for text, *each in zip(texts, *results):
                string, merged = text.decode(), []
                for a, b in sorted((s["start"], s["end"]) for r in each for s in r["spans"]):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(b, merged[-1][1])
                    else:
                        merged.append([a, b])
                # runs that only separators part are one run
                joined = []
                for a, b in merged:
                    if joined and not normal_words(string[joined[-1][1]:a].encode()):
                        joined[-1][1] = b
                    else:
                        joined.append([a, b])
                rows.append({
                    "n_words": each[0]["n_words"],
                    "n_hit": sum(len(normal_words(string[a:b].encode())) for a, b in joined),
                    "items": sorted({i for r in each for i in r["items"]}),
                    "spans": [{"start": a, "end": b} for a, b in joined],
                })
            struct = pa.array(rows, batch.schema.field(parts[0]).type)
            keep = [batch.schema.get_field_index(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], struct], names=[*columns, into])

    return df.mapInArrow(run, schema)


def items_digest(items: F.Column) -> F.Column:
    """Lowercase hex SHA-256 of the comma-joined ids."""
    return F.sha2(F.array_join(items, ","), 256)


def digest_of(ids: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
