"""The operators on edge cases and against brute force, round trips and held-out accuracy."""

import gzip
import hashlib
import itertools
import math
import random
import re
import struct
import tracemalloc
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfold.llm import chat, decontamination, lm_scoring, mixing, quality_rules, sharding, token_output, toxicity, warc
from riskfold.llm.counts import summed
from riskfold.llm.queries import tokenizer_file
from riskfold.llm.tables import ROW, fresh_path, totals_before
from tests.llm.fixtures import edge_docs, edge_rows, words


def files_of(path):
    import glob

    return sorted(glob.glob(f"{path.removeprefix('file:')}/part-*.parquet"))


# ---- 1 mixing ----

def targets_of(sizes):
    """Water filling by hand: sizes by source to targets."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, left, budget = {}, set(order), 1.5 * sum(sizes.values())
    while left:
        level = budget / sum(weight[s] for s in left)
        full = {s for s in left if 2 * sizes[s] <= level * weight[s]}
        if not full:
            return target | {s: level * weight[s] for s in left}
        target |= {s: 2.0 * sizes[s] for s in full}
        budget -= sum(2 * sizes[s] for s in full)
        left -= full
    return target


def test_mix_gives_each_source_its_target(spark):
    docs = edge_docs(spark)
    sized, mixed = mixing.mix(docs, block_words=16)
    sized = sized.collect()
    taken = Counter()
    for r in mixed.collect():
        taken[r[ROW]] += r["words"]
    assert sorted((str(r["id"]), r["size"]) for r in sized) == sorted((str(x[0]), len(words(x[1]))) for x in edge_rows())
    sizes, got = Counter(), Counter()
    for r in sized:
        sizes[r["source"]] += r["size"]
        got[r["source"]] += taken[r[ROW]]
        assert taken[r[ROW]] <= 2 * r["size"]
    want = targets_of(sizes)
    for r in sized:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
    assert {s: got[s] for s in sizes} == {s: math.floor(want[s] + 0.5) for s in sizes}


def test_mix_of_nothing(spark):
    for docs in (edge_docs(spark).where("false"), edge_docs(spark).where("text is null")):
        sized, mixed = mixing.mix(docs)
        assert mixed.count() == 0 and sized.count() == docs.count()


def test_schedule_spreads_each_source(spark):
    blocks = {0: 700, 1: 1, 2: 299}
    rows, first = [], 0
    for s, n in blocks.items():
        rows.append((s, first, n))
        first += n
    slots = mixing.schedule(spark.createDataFrame(rows, "rank int, first long, blocks long"), first, 3).collect()
    by = {s: sorted((r["block"], r["slot"]) for r in slots if r["rank"] == s) for s in blocks}
    for s, n in blocks.items():
        assert [b for b, _ in by[s]] == list(range(len(by[s]))) and len(by[s]) >= n
        assert [x for _, x in by[s]] == sorted(x for _, x in by[s])
    for upto in range(50, 1024, 50):
        for s, n in blocks.items():
            assert abs(sum(x < upto for _, x in by[s]) - upto * n / first) <= 6


def test_mixed_documents_start_each_copy_once(spark):
    docs = edge_docs(spark)
    out = mixing.mixed_documents(docs, block_words=32)
    assert out.columns == docs.columns
    times = Counter(r["doc_id"] for r in out.collect())
    assert max(times[i] for i in (2, 7, 11)) <= 2 and all(i not in times for i in (3, 4, 5, 10))


# ---- 2 chat ----

@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/s[]INST \\\\SYROLE\n" + "é世\U0001f600", max_size=60))
def test_escaping_is_reversible_and_breaks_every_mark(text):
    t = chat.Template()
    escaped = t.escape(text)
    assert t.unescape(escaped) == text
    assert not any(c in escaped for c in t.control)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(
    st.sampled_from(["user", "assistant", "system", "tool", "", "<s>"]),
    st.text(alphabet="<>/s[]INST \\\\\n<", max_size=20)), min_size=1, max_size=6))
def test_formatted_text_is_parsed_back(turns):
    t = chat.Template()
    reader = chat._Reader(1, t, t.parser())
    for no, (role, text) in enumerate(turns):
        for string, loss in t.segments(role, text):
            reader.take(no, string, loss, "start", True)
    row = reader.row()
    want = "".join(f"{r}\n{x}\n" for r, x in turns)
    said = "".join(x for r, x in turns if r == "assistant")
    assert row[1] == len(turns) and row[2] == hashlib.sha256(want.encode()).hexdigest()
    assert row[3] == len(said) and row[4] == hashlib.sha256(said.encode()).hexdigest()


def test_conversations(spark):
    rows = [
        (1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, "assistant", "first"), (2, 1, "user", None),
        (None, None, None, "x"), (None, 0, "user", ""), (3, 0, "system", "s"), (3, 1, "user", "u"), (3, 2, "assistant", "v"),
        (4, 0, "user", "tie"), (4, 0, "user", "tie"), (5, 0, "tool", "</s>"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segment", F.lit(1))
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_chat(df)).collect()}
    assert {k: r["n_turns"] for k, r in got.items()} == {1: 2, 2: 2, None: 2, 3: 3, 4: 2, 5: 1}
    assert {k: r["valid"] for k, r in got.items()} == {1: True, 2: False, None: False, 3: True, 4: False, 5: False}
    assert got[2]["n_wrong_turns"] == 1 and got[5]["n_wrong_turns"] == 1 and got[4]["n_wrong_turns"] == 1
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[None]["turns_sha256"] == sha("\nx\nuser\n\n") and got[2]["loss_sha256"] == sha("first")
    assert chat.read_back(chat.format_chat(df.where("false"))).count() == 0


def test_a_conversation_may_span_batches(spark):
    rows = spark.range(25_000).select(
        F.lit(9).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.col("id").cast("string").alias("text"))
    r = chat.read_back(chat.format_chat(rows)).collect()
    said = "".join(str(i) for i in range(25_000) if i % 2)
    assert len(r) == 1 and r[0]["n_turns"] == 25_000 and r[0]["valid"]
    assert r[0]["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()


# ---- 3 token output ----

def test_token_files(spark):
    from tokenizers import Tokenizer

    path = fresh_path(spark, "test-tokens")
    docs = edge_docs(spark)
    token_output.write_tokens(docs, path, tokenizer_file())
    t = Tokenizer.from_file(tokenizer_file())
    want, start = [], 0
    for d, text, *_ in sorted(edge_rows(), key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        want.append((d, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    rows = token_output.with_checksums(token_output.read_tokens(spark, path)).collect()
    assert sorted(map(str, ((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows))) == sorted(map(str, want))
    meta = token_output.read_metadata(spark, path)
    assert sorted(map(str, meta.collect())) == sorted(map(str, meta.collect())) and meta.columns == ["doc_id", "start", "n_tokens"]
    plan = spark._jvm.PythonSQLUtils.explainString(meta._jdf.queryExecution(), "formatted")
    assert all("ids" not in s for s in re.findall(r"ReadSchema: (.*)", plan))
    for f in files_of(path):
        group = pq.ParquetFile(f).metadata.row_group(0)
        columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
        assert any("DICTIONARY" in e for e in columns["ids.list.element"].encodings)
        assert any("DELTA" in e for e in columns["offset"].encodings)
        assert all(c.has_column_index and c.has_offset_index for c in columns.values())


def test_token_files_of_nothing(spark):
    path = fresh_path(spark, "test-tokens")
    token_output.write_tokens(edge_docs(spark).where("false"), path, tokenizer_file())
    assert token_output.read_tokens(spark, path).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB0'é́ \n\t\x1f\x85ΣßİÅ각日क़|<startofend>123.,!-", max_size=40), min_size=1, max_size=5))
def test_word_encoder_equals_the_tokenizer(texts):
    encoder = token_output.WordEncoder.of(tokenizer_file())
    ids, n = encoder([t.encode() for t in texts], 1)
    want = [e.ids + [1] for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert n.tolist() == [len(w) for w in want] and ids.tolist() == list(itertools.chain.from_iterable(want))


def test_word_encoder_forgets_only_late_words(monkeypatch):
    monkeypatch.setattr(token_output, "MOST_WORDS", 3)
    encoder = token_output.WordEncoder(tokenizer_file())
    first = [encoder([t], 1)[0].tolist() for t in (b"a b c d e", b"f g a", b"d e f zz")]
    assert len(encoder.numbers) == 3 and len(encoder.starts) == 4
    assert first == [e.ids + [1] for e in encoder.tokenizer.encode_batch(["a b c d e", "f g a", "d e f zz"], add_special_tokens=False)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aBéßİªÅ各क़Σ\u0301\u024f\u0250\0017.,!-", min_size=1, max_size=5), min_size=1, max_size=8))
def test_kinds_of_words_at_once_equal_one_by_one(words):
    codes = np.frombuffer("\n".join([*words, ""]).encode("utf-32-le"), dtype="<u4")
    kinds = token_output._kinds(codes, np.flatnonzero(codes == 10), words)
    assert kinds.tolist() == [token_output._parts(w) for w in words]


# ---- 4 WARC ----

def test_archives_round_trip(spark):
    big = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 200 + "é世\U0001f600" * 500
    rows = [
        (5, "http://a/%0A\n", big, 0), (3, "http://b", big, 0), (3, "http://b", big, 0), (None, None, big, 0),
        (7, "u", None, 0), (8, "u", "", 0), (9, "v", "short", 0), (10, "v", "short", 0), (1, "w", "y" * 100, 0),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int").repartition(3)
    path = fresh_path(spark, "test-warc")
    warc.write_warc(pages, path, segment_bytes=1000, file_records=7)
    got = warc.read_warc(spark, path).collect()
    assert len(got) == len(rows)
    assert Counter(r["record_type"] for r in got) == {"response": 6, "revisit": 3}
    stored = {r["record_id"]: r for r in got if r["record_type"] == "response"}
    assert len(stored) == 6
    payload = lambda r: (stored[r["refers_to_id"]] if r["refers_to_id"] else r)["payload"].decode()
    assert sorted(map(str, ((r["page_id"], r["url"], payload(r)) for r in got))) == sorted(
        str((p, u, h or "")) for p, u, h, _ in rows)
    for r in got:
        assert r["payload_digest"] == hashlib.sha256(payload(r).encode()).hexdigest()
        if r["refers_to_id"]:
            assert stored[r["refers_to_id"]]["page_id"] == 3
    kinds = Counter(r["record_type"] for r in warc.read_records(spark, path).collect())
    assert kinds["continuation"] >= 10
    some = warc.read_records(spark, path).where("segment is null or segment <> 2")
    with pytest.raises(Exception, match="segments are missing"):
        warc.reassembled(some).collect()


def test_addresses_are_archived_as_they_are(spark):
    urls = ["http://a/x%20y", "http://a/?q=%250A&r=é", "", None, " http://b", "http://c/%0D\r\n"]
    pages = spark.createDataFrame([(i, u, f"page {i}") for i, u in enumerate(urls)], "page_id long, url string, html string")
    path = fresh_path(spark, "test-warc")
    warc.write_warc(pages, path)
    assert {r["page_id"]: r["url"] for r in warc.read_warc(spark, path).collect()} == dict(enumerate(urls))
    raw = "".join(r["value"] for r in spark.read.option("lineSep", "\r\n\r\n").text(path).collect())
    assert "WARC-Target-URI: http://a/x%20y\r\n" in raw and "WARC-Target-URI: http://a/?q=%250A&r=é\r\n" in raw


def test_archives_of_nothing(spark):
    path = fresh_path(spark, "test-warc")
    warc.write_warc(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_warc(spark, path).count() == 0


def test_a_task_reads_archives_with_one_worker(spark):
    path = fresh_path(spark, "test-warc")
    pages = [(i, f"http://{i}", "é" * size) for i, size in enumerate((0, 5, 100, 5000))]
    warc.write_warc(spark.createDataFrame(pages, "page_id long, url string, html string"), path, segment_bytes=1000)
    read = warc.read_warc(spark, path)
    assert {r["page_id"]: r["payload"].decode() for r in read.collect()} == {i: h for i, _, h in pages}
    plan = spark._jvm.PythonSQLUtils.explainString(read._jdf.queryExecution(), "simple")
    above = []  # nodes from the root to this line's
    for line in plan.splitlines()[1:]:
        depth = len(line) - len(line.lstrip(" :+-"))
        above = [x for x in above if x[0] < depth] + [(depth, line.lstrip(" :+-").split(" ")[0])]
        stage = "".join("|" if n == "Exchange" else "M" if n == "MapInArrow" else "" for _, n in above)
        assert "MM" not in stage, plan


def test_workers_hold_archives_and_records_in_pieces():
    archive = warc.unpacked(gzip.compress(bytes(20 << 20)), 1 << 16)
    assert max(map(len, archive)) == 1 << 16
    taken = []
    rows = ((taken.append(i), bytes(10_000))[1:] for i in range(2000))  # 20 MB in all
    schema = T.StructType([T.StructField("record", T.BinaryType())])
    sizes, ahead = [], []
    for batch in warc._batches(rows, schema):
        sizes.append(batch.num_rows)
        ahead.append(len(taken) - sum(sizes))
    assert sum(sizes) == 2000 and max(ahead) == 0 and max(sizes) * 10_000 <= warc.PIECE_BYTES + 10_000


def test_archives_in_parts_equal_whole_ones():
    rng = random.Random(4)
    pages = [rng.randbytes(rng.choice((0, 5, 900, 2500))) + b"\r\n\r\nWARC/1.1\r\n" for _ in range(20)]
    records = [r for i, p in enumerate(pages) for r in warc.records_of(i, i, f"http://{i}", p, "d", True, False, 1000)]
    data = b"".join(r + warc.END for r in records)
    whole = list(warc.parsed([data]))
    assert len(whole) == len(records) and [r[2] for r in whole if r[1] == "response"] == list(range(20))
    for size in (1, 3, 64, 1000, 5000):
        assert list(warc.parsed(data[i:i + size] for i in range(0, len(data), size))) == whole
        packed = gzip.compress(data)
        assert list(warc.parsed(warc.unpacked(packed, size + 1))) == whole
        with pytest.raises(ValueError, match="cut off"):
            list(warc.parsed(warc.unpacked(packed[:-5], size + 1)))
        with pytest.raises(ValueError, match="length"):
            list(warc.parsed(data[i:min(i + size, len(data) - 2)] for i in range(0, len(data) - 2, size)))


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=300), st.integers(1, 40))
def test_chunked_framing(payload, size):
    assert warc.unchunked(warc.chunked(payload, size)) == payload
    if payload:
        with pytest.raises(ValueError):
            warc.unchunked(warc.chunked(payload, size)[:-8])


# ---- 5 sharding ----

def test_shards(spark):
    docs = edge_docs(spark).withColumn("bucket", F.lit(1))
    out = sharding.with_slots(sharding.with_shards(docs, ["doc_id"], [1.0] * 5), "shard", ["doc_id"], ["text"])
    rows = out.collect()
    assert len(rows) == len(edge_rows()) and out.columns == [*docs.columns, "shard", "slot"]
    for s in range(5):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    assert len({r["shard"] for r in rows if r["doc_id"] == 1}) == 1
    assert sharding.with_slots(sharding.with_shards(docs.where("false"), ["doc_id"], [1.0]), "shard", ["doc_id"]).count() == 0
    plan = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    assert not re.search("MapIn|ArrowEval|BatchEval|Pandas", plan)


def test_a_new_shard_only_takes(spark):
    ids = spark.range(20_000)
    both = sharding.with_shards(sharding.with_shards(ids, ["id"], [1.0] * 9, "a"), ["id"], [1.0] * 10, "b").collect()
    assert all(r["a"] == r["b"] or r["b"] == 9 for r in both)
    assert abs(sum(r["b"] == 9 for r in both) - 2000) < 250
    weighted = Counter(r["s"] for r in sharding.with_shards(ids, ["id"], [1.0, 3.0, 0.0, 4.0], "s").collect())
    assert weighted[2] == 0 and abs(weighted[1] - 7500) < 400 and abs(weighted[3] - 10_000) < 400
    with pytest.raises(ValueError):
        sharding.rendezvous_shard([F.col("id")], [0.0])


# ---- 6 quality rules ----

def repeats_by_hand(w, least):
    n = len(w)
    longest, places = [0] * n, {}
    for i in range(n):
        for j in range(i + 1, n):
            k = 0
            while j + k < n and w[i + k] == w[j + k]:
                k += 1
            if k >= least:
                longest[i], longest[j] = max(longest[i], k), max(longest[j], k)
        for k in range(least, n - i + 1):
            places.setdefault(tuple(w[i:i + k]), []).append(i)
    covered = {k for i in range(n) for k in range(i, i + longest[i])}
    maximal = 0
    for s, at in places.items():
        left = {w[p - 1] if p else None for p in at}
        right = {w[p + len(s)] if p + len(s) < n else None for p in at}
        maximal += len(at) > 1 and (len(left) > 1 or None in left) and (len(right) > 1 or None in right)
    return len(covered), max(longest, default=0), maximal


def test_suffix_array_repeats():
    rng = random.Random(1)
    for _ in range(120):
        texts = [" ".join(rng.choice("abcdef"[:rng.choice([1, 2, 3, 6])]) for _ in range(rng.randrange(0, 40))).encode()
                 for _ in range(rng.randrange(1, 5))]
        least = rng.choice([1, 2, 3, 5, 8])
        m = quality_rules.measures(texts, quality_rules.RepeatLimits(least, 0.3, 200))
        for i, t in enumerate(texts):
            w = t.decode().split()
            assert (m["covered_words"][i], m["longest_repeat"][i], m["n_maximal_repeats"][i]) == repeats_by_hand(w, least)
            windows = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
            inside = {j for k in range(len(w) - 4) if windows[tuple(w[k:k + 5])] > 1 for j in range(k, k + 5)}
            assert m["n_repeat_words"][i] == len(inside)


def test_quality_of_edge_cases(spark):
    docs = edge_docs(spark).withColumn("kept", F.lit("x"))
    out = quality_rules.quality(docs, into="q")
    rows = out.collect()
    assert out.columns == [*docs.columns, "q"] and len(rows) == len(edge_rows())
    for r in rows:
        text, q = r["text"] or "", r["q"]
        w = words(text)
        lines = [x for x in text.split("\n") if words(x)]
        assert (q["n_words"], q["word_chars"], q["n_symbols"], q["n_dup_lines"]) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)))
        assert q["base_failed"] == (len(w) < 10 or 100 * q["n_repeat_words"] > 20 * len(w))
        assert not (q["kept"] and q["base_failed"])
    kept = {r["doc_id"] for r in rows if r["q"]["kept"]}
    assert {1, 2, 11, 12} <= kept and not {3, 4, 5, 6, 8, 9, 10, 13, 14} & kept
    assert quality_rules.quality(docs.where("false")).count() == 0


def test_one_long_repeat_fails_where_the_base_rules_pass(spark):
    rng = random.Random(2)
    word = lambda: f"w{rng.randrange(10**6)}"
    passage = [word() for _ in range(60)]
    text = " ".join([word() for _ in range(1000)] + passage + [word() for _ in range(500)] + passage)
    q = quality_rules.measures([text.encode()], quality_rules.RepeatLimits())
    assert not q["base_failed"][0] and q["longest_repeat"][0] == 60 and not q["kept"][0]


def test_a_quality_worker_measures_texts_in_small_pieces():
    rng = random.Random(3)
    texts = [" ".join(rng.choice(("word", "other", "third")) + str(rng.randrange(500)) for _ in range(2_500)) for _ in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(texts)], names=["doc_id", "text"])
    fields = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    # the function that Spark would run in its tasks
    run = quality_rules.quality(SimpleNamespace(schema=fields, columns=fields.names, mapInArrow=lambda run, schema: run), into="q")
    tracemalloc.start()
    try:
        got = pa.Table.from_batches(run([batch]))["q"].to_pylist()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [r["n_words"] for r in got] == [2_500] * 300
    assert peak < 15 * sum(map(len, texts)), peak


# ---- 7 decontamination ----

def test_leaks_in_blocks_and_offsets(spark):
    items = spark.createDataFrame([
        (1, "one two three four five six seven eight nine ten eleven"), (2, "Short Item"), (3, None), (4, "!!"),
        (None, "tie tie"), (5, "tie tie"), (5, "tie tie"), (6, "é世 x"), (7, "four five six seven eight nine ten eleven twelve x13")],
        "item_id long, text string")
    texts = ["zero ONE two-three four, five six seven eight nine ten ELEVEN twelve x13 end", "a short   item here, short item",
             "no", None, "", "tie tie tie", "pre É世 x é世 X post", "\x00 one two three four five six seven eight nine", "tie"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("items", F.lit(0))
    want = None
    for size in (64 << 20, 40):
        rows = {r["doc_id"]: r["x"] for r in decontamination.decontaminate(docs, items, into="x", block_chars=size).collect()}
        got = {d: (r["n_words"], r["n_hit"], r["items"], [tuple(s) for s in r["spans"]]) for d, r in rows.items()}
        want = want or got
        assert got == want
    assert want[0][:3] == (15, 13, ["1", "7"]) and texts[0][slice(*want[0][3][0])].lower().startswith("one two")
    assert texts[0][slice(*want[0][3][0])].endswith("x13")
    assert want[1][:3] == (6, 4, ["2"]) and [texts[1][a:b] for a, b in want[1][3]] == ["short   item", "short item"]
    assert want[5][:3] == (3, 3, ["", "5"]) and want[8][:3] == (1, 0, [])
    assert want[6][:3] == (6, 2, ["6"])  # only A-Z are lower-cased
    assert want[2][1] == want[7][1] == 0 and want[3] == want[4] == (0, 0, [], [])
    none = decontamination.decontaminate(docs, items.where("false"), into="x")
    assert all(r["x"]["n_hit"] == 0 for r in none.collect())
    assert decontamination.decontaminate(docs.where("false"), items, into="x").count() == 0


# ---- 8 language model ----

def lm_fixture():
    rng, rows = random.Random(3), []
    left, right = [f"l{i}" for i in range(30)], [f"r{i}" for i in range(30)]
    for i in range(400):
        n = rng.randrange(0, 30)
        text = " ".join(w for _ in range(n) for w in (rng.choice(left), rng.choice(right)))
        rows.append((i, text + (f" Rare{i}" if i % 3 else "")))
    return [*rows, (400, None), (401, ""), (None, "l1 r1"), (7, "l1 r1 l2"), (402, "ſ \x1f Ünseen " * 3)]


def test_scores_against_counts_by_hand(spark):
    rows = lm_fixture()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("x")).repartition(4)
    got = lm_scoring.lm_scores(df, lm_scoring.trained(F.col("doc_id")), classes=4, exchange_words=40, known_most=50).collect()
    crc = lambda d: zlib.crc32(b"" if d is None else str(d).encode()) % 7
    tokens = lambda t: words("".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) + ["\n"]
    counts = Counter(w for d, t in rows if crc(d) != 2 for w in tokens(t))
    total, types = sum(counts.values()), len(counts)
    want = []
    for d, t in rows:
        base = sum(math.log10((counts[w] + 1) / (total + types + 1)) for w in tokens(t))
        want.append((str(d), crc(d) == 2, len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), total, round(base, 6)))
    assert sorted(want) == sorted(
        (str(r["id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got)
    for held in (True, False):
        some = [r for r in got if r["held_out"] == held]
        assert sum(r["score"] for r in some) > sum(r["base_score"] for r in some)
        assert all(r["score"] < 0 and r["perplexity"] == pytest.approx(10 ** (-r["score"] / r["n_tokens"])) for r in some)
    empty = lm_scoring.lm_scores(df.where("false"), lm_scoring.trained(F.col("doc_id")))
    assert empty.count() == 0
    unseen = lm_scoring.lm_scores(df, F.lit(False)).collect()
    assert len(unseen) == len(rows) and all(r["train_tokens"] == 0 and r["base_score"] == 0 for r in unseen)


def test_the_class_model_is_a_probability(spark):
    rows = [(i, t) for i, (_, t) in enumerate(lm_fixture())]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    vocabulary = lm_scoring.count_words(df, "text")
    held = {r["word"]: r["n"] for r in vocabulary.collect()}
    known, counts, _ = lm_scoring.known_words(vocabulary, 50)
    encoded = lm_scoring.encode(df, "text", known)
    texts = held[lm_scoring.END]
    m = lm_scoring.fit(encoded, counts, sum(held.values()), len(held), texts, classes=4, exchange_words=20)
    rare = [n for w, n in held.items() if w not in known and w != lm_scoring.END]
    emits = 10 ** m.emits[:len(known)]
    for before in range(len(m.moves)):
        moves = 10 ** m.moves[before]
        total = (moves[m.classes[:len(known)]] * emits).sum() + moves[m.classes[len(known) + 1]]
        total += moves[m.classes[len(known)]] * (sum(rare) + (len(rare) + 1) * lm_scoring.RARE_MASS) / m.rare_total
        assert total == pytest.approx(1)
    assert len(known) <= 50 and min(counts) > 1


def test_words_without_a_number_have_classes_too(spark):
    df = spark.createDataFrame(lm_fixture(), "doc_id long, text string").repartition(4)
    some, every = (
        {(r["id"], r["n_tokens"]): (r["score"], r["base_score"]) for r in lm_scoring.lm_scores(
            df, lm_scoring.trained(F.col("doc_id")), classes=4, exchange_words=4, known_most=most).collect()}
        for most in (12, 1000))
    assert some.keys() == every.keys()
    for row in every:
        assert some[row] == pytest.approx(every[row])


def test_all_words_move_until_few_gain(spark):
    rng = random.Random(8)
    sides = [[f"l{i}" for i in range(40)], [f"r{i}" for i in range(40)]]
    heads = [f"h{i % 2}" for i in range(60)]  # frequent, and beside words of either side
    texts = [" ".join(w for _ in range(12) for w in (rng.choice(sides[0]), rng.choice(sides[1]), rng.choice(heads))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    vocabulary = lm_scoring.count_words(df, "text")
    held = {r["word"]: r["n"] for r in vocabulary.collect()}
    words, counts, _ = lm_scoring.known_words(vocabulary, 1000)
    m = lm_scoring.fit(lm_scoring.encode(df, "text", words), counts, sum(held.values()), len(held), 300, classes=2, exchange_words=2)
    by_side = [{m.classes[i] for i, w in enumerate(words) if w[0] == side} for side in "lrh"]
    assert [len(s) for s in by_side] == [1, 1, 1] and by_side[0] == by_side[1] != by_side[2]


def test_best_class_equals_brute_force():
    rng = np.random.default_rng(4)
    n, classes = 30, 4  # then the rare words' class and the end's
    counts = rng.integers(0, 4, (n, n))
    of = np.concatenate((rng.integers(0, classes + 1, n - 2), [classes, classes + 1]))

    def value(of):
        member = np.eye(classes + 2)[of]
        table = member.T @ counts @ member
        h = lambda x: (x * np.log(np.maximum(x, 1))).sum()
        return h(table) - h(table.sum(axis=0)) - h(table.sum(axis=1))

    counts += counts.T  # so each word is as often first as second
    member = np.eye(classes + 2, dtype=np.int64)[of]
    around = np.hstack((counts.T @ member, counts @ member, np.diagonal(counts)[:, None]))
    got = lm_scoring.best_classes(member.T @ counts @ member, member.T @ counts.sum(axis=0), around, counts.sum(axis=0), of, classes)
    for w in range(n - 2):
        values = [value(np.where(np.arange(n) == w, c, of)) for c in range(classes)]
        if of[w] < classes:
            assert values[got[w]] == pytest.approx(max(values))
        else:  # it joins a class without leaving one
            assert got[w] < classes


def test_exchange_separates_words_by_context():
    rng = np.random.default_rng(0)
    n = 40
    table = np.zeros((n + 2, n + 2), dtype=np.int64)
    for _ in range(20_000):  # even words before odd ones, and the reverse
        a = rng.integers(0, n)
        b = (rng.integers(0, n // 2) * 2 + (a + 1) % 2)
        table[a, b] += 1
    of = lm_scoring.exchange(table, 2)
    assert len({of[i] for i in range(0, n, 2)}) == 1 and len({of[i] for i in range(1, n, 2)}) == 1 and of[0] != of[1]
    assert of[n] == 2 and of[n + 1] == 3


def test_sums_over_many_tasks(spark):
    df = spark.range(0, 10_000, numPartitions=40)

    def add():
        def more(batch, totals):
            totals += np.bincount(batch.column(0).to_numpy() % 7, minlength=7)

        return more

    assert summed(df, 7, add, "test-sum").tolist() == np.bincount(np.arange(10_000) % 7).tolist()
    assert summed(df.where("false"), 7, add, "test-sum").tolist() == [0] * 7


# ---- 9 toxicity ----

def test_marginals_equal_enumeration():
    rng = np.random.default_rng(4)
    counts = np.array([3, 0, 1, 6, 4])
    odds, moves = np.exp(rng.normal(size=counts.sum())), np.exp(rng.normal(size=(2, 2)))
    lattice = toxicity.Lattice(counts)
    placed = np.empty_like(odds)
    placed[lattice.place] = odds
    alpha, beta = toxicity.forward_backward(lattice, placed, moves)
    got = (alpha * beta / (1 + alpha * beta))[lattice.place]
    at = 0
    for n in counts:
        weight, total = np.zeros(n), 0.0
        for states in itertools.product((0, 1), repeat=int(n)):
            w = np.prod([odds[at + i] if s else 1.0 for i, s in enumerate(states)])
            w *= np.prod([moves[a, b] for a, b in zip(states, states[1:])])
            total += w
            weight += w * np.array(states)
        assert got[at:at + n] == pytest.approx(weight / total) if n else True
        at += n


def toxic_fixture(n=700, seed=6):
    rng = random.Random(seed)
    calm, bad = [f"calm{i}" for i in range(300)], ["vile", "grimword", "Nastyish"]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(calm) for _ in range(rng.randrange(5, 40))]
        if toxic := i % 5 == 1:
            for _ in range(rng.randrange(1, 4)):
                text.insert(rng.randrange(len(text)), rng.choice(bad))
        docs.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_toxic_documents_and_offsets(spark):
    docs, labels = toxic_fixture()
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit(1))
    lab = spark.createDataFrame([*labels, labels[0], (None, 1), (5, None)], "doc_id long, toxic int")
    field = toxicity.fit(d, lab, ~toxicity.held_out(F.col("doc_id")))
    rows = toxicity.score(d, field, into="t").withColumn("held", toxicity.held_out(F.col("doc_id"))).collect()
    truth = dict(labels)
    held = [r for r in rows if r["held"]]
    assert 100 < len(held) < 180 and all(r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert sum((r["t"]["score"] >= 0.5) == (truth[r["doc_id"]] == 1) for r in held) / len(held) > 0.97
    found = Counter(r["text"][s["start"]:s["end"]].lower() for r in rows for s in r["t"]["spans"])
    assert {w for s in found for w in s.split()} == {"vile", "grimword", "nastyish"}
    again = toxicity.fit(d, lab, ~toxicity.held_out(F.col("doc_id")))
    assert np.array_equal(again.own, field.own) and np.array_equal(again.document, field.document)
    edge = toxicity.score(edge_docs(spark), field, into="t")
    assert edge.columns == [*edge_docs(spark).columns, "t"]
    scores = edge.collect()
    assert len(scores) == len(edge_rows()) and all(0 <= r["t"]["score"] <= 1 and r["t"]["spans"] == [] for r in scores)
    assert toxicity.score(d.where("false"), field).count() == 0


def test_toxicity_without_labels(spark):
    docs, labels = toxic_fixture(30)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    for some in (lab.where("false"), lab.where("toxic = 0"), lab.where("toxic = 1")):
        field = toxicity.fit(d, some, F.lit(True))
        rows = toxicity.score(d, field, into="t").collect()
        assert len(rows) == 30 and all(0 <= r["t"]["score"] <= 1 for r in rows)


# ---- shared helpers ----

def test_totals_before(spark):
    rows = [(k, v) for k, v in zip([5, 3, 3, None, 8, 1], [1, 2, 2, 4, 5, 6])]
    df = spark.createDataFrame(rows, "k int, v int")
    got = totals_before(df, [F.col("k").asc_nulls_last()], {"s": F.col("v"), "i": F.lit(1)}, "test-totals").collect()
    assert sorted((r["k"] or 99, r["v"], r["s"], r["i"]) for r in got) == [
        (1, 6, 0, 0), (3, 2, 6, 1), (3, 2, 8, 2), (5, 1, 10, 3), (8, 5, 11, 4), (99, 4, 16, 5)]
