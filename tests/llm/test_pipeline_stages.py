"""The pipeline on edge cases, and its stages against brute force on a small fixture."""

import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from riskfold.llm.queries import tokenizer_file
from riskfold.llm.quality_rules import RepeatLimits, measures
from riskfold.sources.tables import read_table
from tests.conftest import SF001
from tests.llm.fixtures import COLUMNS, edge_docs, words


def test_stages_and_columns():
    assert [n for n, _ in P.STAGES] == ["quality", "near_copies", "decontamination", "mixing", "tokens"]


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = read_table(spark, SF001, "documents"), {}
    out["documents"] = docs.collect()
    for name, f in P.STAGES:
        from riskfold.llm.tables import written

        docs = written(f(spark, docs, SF001), name)
        out[name] = docs.collect()
        if name != "tokens":
            assert docs.columns == read_table(spark, SF001, "documents").columns
    return out


def _shingles(text):
    w = words(text.lower() if text else "")
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_quality_keeps_what_passes(stages):
    texts = [r["text"].encode() for r in stages["documents"]]
    kept = measures(texts, RepeatLimits())["kept"]
    assert {r["doc_id"] for r in stages["quality"]} == {r["doc_id"] for r, k in zip(stages["documents"], kept) if k}


def test_one_of_each_group_stays(stages):
    rows = sorted(stages["quality"], key=lambda r: r["doc_id"])
    sets = [_shingles(r["text"]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n and 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    assert sorted(r["doc_id"] for r in stages["near_copies"]) == [rows[i]["doc_id"] for i in range(len(rows)) if find(i) == i]


def test_contaminated_documents_go(spark, stages):
    import re

    def norm(t):
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))

    windows = set()
    for r in read_table(spark, SF001, "benchmark").collect():
        w = norm(r["text"])
        windows |= {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(w) for w in windows}

    def hit(t):
        w = norm(t)
        return any(tuple(w[i:i + n]) in windows for n in sizes for i in range(len(w) - n + 1))

    assert sorted(r["doc_id"] for r in stages["decontamination"]) == sorted(
        r["doc_id"] for r in stages["near_copies"] if not hit(r["text"]))


def test_mix_takes_each_source_near_its_target(stages):
    before, after = {}, {}
    for rows, sizes in ((stages["decontamination"], before), (stages["mixing"], after)):
        for r in rows:
            sizes.setdefault(r["source"], []).append(len(words(r["text"])))
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(before))}
    target, left, budget = {}, set(before), 1.5 * sum(map(sum, before.values()))
    while left:
        level = budget / sum(weights[s] for s in left)
        full = {s for s in left if 2 * sum(before[s]) <= level * weights[s]}
        if not full:
            target |= {s: level * weights[s] for s in left}
            break
        target |= {s: 2.0 * sum(before[s]) for s in full}
        budget -= sum(2 * sum(before[s]) for s in full)
        left -= full
    for s in before:
        assert -1 <= sum(after.get(s, [])) - target[s] <= max(before[s])
    times = {}
    for r in stages["mixing"]:
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    assert max(times.values()) <= 2


def test_tokens_are_those_of_the_mixed_documents(stages):
    import struct

    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_file())
    want, start = [], 0
    for r in sorted(stages["mixing"], key=lambda r: r["doc_id"]):
        ids = t.encode(r["text"], add_special_tokens=False).ids + [1]
        want.append((r["doc_id"], start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in stages["tokens"]) == sorted(want)


@pytest.mark.parametrize("i", range(len(P.STAGES)))
def test_each_stage_takes_edge_cases_and_empty_tables(spark, i):
    name, stage = P.STAGES[i]
    docs = edge_docs(spark)
    out = stage(spark, docs, SF001)
    rows = out.collect()
    if name != "tokens":
        assert out.columns == docs.columns
        assert {r["doc_id"] for r in rows} <= {r["doc_id"] for r in docs.collect()}
    else:
        assert len(rows) == docs.count()
    empty = stage(spark, docs.where("false"), SF001)
    assert empty.count() == 0 and (name == "tokens" or empty.columns == docs.columns)
    assert stage(spark, docs.select(*COLUMNS).where(F.col("text").isNull()), SF001).collect() is not None


def test_one_row_of_repeated_rows_and_null_ids_stays(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame(
        [(None, text, "x"), (None, text, "x"), (7, text + " more", "y"), (7, text + " more", "y"), (3, "other words", None)],
        "doc_id long, text string, __row string")
    rows = sorted(P.near_copies(spark, docs, SF001).collect(), key=str)
    assert [(r["doc_id"], r["__row"]) for r in rows] == [(3, None), (7, "y")]


def test_run_gives_the_last_stage(spark, stages):
    rows = P.run(spark, SF001).collect()
    key = lambda r: (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"])
    assert sorted(map(key, rows)) == sorted(map(key, stages["tokens"]))

