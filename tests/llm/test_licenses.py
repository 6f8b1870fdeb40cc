"""License scans against plain loops over words, blocks and templates."""

import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskfold.llm import licenses
from riskfold.llm.queries import op11_license_scan
from riskfold.llm.text import starts_of
from tests.conftest import SF001
from tests.llm.fixtures import edge_docs


def normal(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_scan(text, templates=licenses.TEMPLATES, phrases=licenses.PHRASES, threshold=licenses.THRESHOLD):
    """n_words, places, and (label, start, end, share) of each block, by trying everything."""
    words = normal(text)
    places = sorted(
        (i, label) for p, label in phrases for i in range(len(words)) if words[i:i + len(normal(p))] == normal(p))
    half = max(len(normal(t)) for _, t in templates)
    blocks, start = [], 0
    while words:
        block = set(words[start:start + 2 * half])
        for label, t in templates:
            need = set(normal(t))
            shared = len(block & need)
            if 100 * shared >= threshold * len(need):
                blocks.append((label, start, min(start + 2 * half, len(words)), shared / len(need)))
        start += half
        if start + half >= len(words):
            break
    return len(words), places, blocks


def same(row, text, **options):
    n, places, blocks = plain_scan(text, **options)
    assert (row["n_words"], row["n_base"]) == (n, len(places))
    assert (row["first_word"], row["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
    assert row["base_labels"] == sorted({label for _, label in places})
    assert sorted(tuple(b) for b in row["blocks"]) == sorted(blocks)
    assert [b["start"] for b in row["blocks"]] == sorted(b["start"] for b in row["blocks"])


def notices():
    rng = random.Random(3)
    fill = [f"w{i}" for i in range(50)] + ["the", "of", "and", "license", "version", "to", "is"]
    out = []
    for label, t in licenses.TEMPLATES:
        words = t.split()
        for drop in (0, 1, len(words) // 5, len(words) // 3):
            kept = [w for i, w in enumerate(words) if i not in set(rng.sample(range(len(words)), drop))]
            before, after = ([rng.choice(fill) for _ in range(rng.randrange(80))] for _ in range(2))
            if drop:
                rng.shuffle(kept)
            out.append(" ".join([*before, *kept, *after]))
    out.append(" ".join(t for _, t in licenses.TEMPLATES))
    out += ["mit license", "MIT LICENSE mit license", "mit\nlicense", "mit-license; cc by-cc by", "the mit licenses", "cc", "by cc", "É mit license é"]
    return out


def test_scan_equals_plain_loops(spark):
    texts = dict(enumerate(notices()))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    rows = licenses.scan(docs).select("doc_id", "licenses.*").collect()
    assert len(rows) == len(texts)
    for r in rows:
        same(r, texts[r["doc_id"]])
    assert sum(len(r["blocks"]) for r in rows) > 40


def test_scan_of_edge_rows_and_clashing_names(spark):
    docs = edge_docs(spark).withColumn("licenses", F.lit("mine"))
    out = licenses.scan(docs)
    assert out.columns == [*docs.columns, "_licenses"]
    rows = out.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["licenses"] == "mine"
        same(r["_licenses"], r["text"])
    empty = licenses.scan(docs.where("false"))
    assert empty.columns == out.columns and empty.count() == 0


def test_scan_in_groups_of_templates_equals_one_pass(spark, monkeypatch):
    docs = spark.createDataFrame(list(enumerate(notices()[:20])), "doc_id long, text string")
    rows = lambda df: sorted(
        (r["doc_id"], r["n_base"], sorted(tuple(b) for b in r["blocks"])) for r in df.select("doc_id", "licenses.*").collect())
    want = rows(licenses.scan(docs, templates=licenses.TEMPLATES[:6]))
    monkeypatch.setattr(licenses, "MOST_WORDS", 25)
    assert len(list(licenses._groups(licenses.TEMPLATES[:6]))) > 2
    assert rows(licenses.scan(docs, templates=licenses.TEMPLATES[:6])) == want


def test_scan_without_templates_or_with_empty_ones(spark):
    docs = spark.createDataFrame([(1, "the mit license")], "doc_id long, text string")
    for templates in ([], [("x", ""), ("y", "--")]):
        r = licenses.scan(docs, templates=templates).first()["licenses"]
        assert r["blocks"] == [] and r["base_labels"] == ["mit"] and r["first_word"] == 1


def test_a_text_larger_than_a_piece(spark):
    rng = random.Random(1)
    words = [f"w{rng.randrange(5000)}" for _ in range(1_500_000)]
    words[700_000:700_000] = "Licensed under the Apache License, Version 2.0".split()
    text = " ".join(words)
    assert len(text) > 8 << 20
    docs = spark.createDataFrame([(1, text), (2, "x")], "doc_id long, text string")
    r = {r["doc_id"]: r["licenses"] for r in licenses.scan(docs).collect()}[1]
    assert r["n_words"] == len(normal(text)) and r["first_word"] == r["last_word"] == 700_003
    assert {b["label"] for b in r["blocks"]} == {"apache-2.0"}


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.lists(st.integers(0, 8), min_size=1, max_size=6), min_size=1, max_size=4),
    st.lists(st.lists(st.integers(0, 11), max_size=40), min_size=1, max_size=3),
    st.lists(st.integers(0, 5), min_size=9, max_size=9), st.sampled_from([34, 50, 80, 100]))
def test_filters_lose_and_add_nothing(templates, texts, counts, threshold):
    named = [(f"t{i}", " ".join(f"v{w}" for w in t)) for i, t in enumerate(templates)]
    half = max(len(t) for t in templates)
    found = licenses.Templates(named, {f"v{i}".encode(): c for i, c in enumerate(counts)}, threshold, half)
    numbers = np.array([found.numbers.get(f"v{w}".encode(), -1) for t in texts for w in t], dtype=np.int64)
    text, block, template, shared = found.find(numbers, starts_of(np.array([len(t) for t in texts])))
    got = sorted(zip(text.tolist(), (block * half).tolist(), template.tolist(), shared.tolist()))
    want = []
    for i, t in enumerate(texts):
        _, _, blocks = plain_scan(" ".join(f"v{w}" for w in t), named, [], threshold)
        sizes = {label: len(set(normal(x))) for label, x in named}
        want += [(i, start, int(label[1:]), round(share * sizes[label])) for label, start, _, share in blocks]
    assert got == sorted(want)


def test_registered_query_names_what_the_operator_finds(spark):
    rows = op11_license_scan(spark, SF001).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        _, places, blocks = plain_scan(texts[r["doc_id"]])
        base = {label for _, label in places}
        assert r["base_labels"] == ",".join(sorted(base))
        assert r["labels"] == ",".join(sorted(base | {b[0] for b in blocks}))
        assert r["score"] == (1.0 if base else max((b[3] for b in blocks), default=0.0))
