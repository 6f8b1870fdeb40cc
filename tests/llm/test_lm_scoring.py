"""The neighbour table, the gains and the classes of language-model scoring against plain loops."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskfold.llm import lm_scoring, text
from riskfold.llm.queries import op8_lm_scoring
from tests.conftest import SF001
from tests.llm.fixtures import words


def test_gains_of_all_classes_equal_a_loop():
    rng = np.random.default_rng(2)
    h = lambda x: x * math.log(max(x, 1))
    for _ in range(20):
        width = int(rng.integers(3, 9))
        classes = width - 2
        table = rng.integers(0, 5, (width, width)).astype(float)
        after, ahead = (rng.integers(0, 4, width).astype(float) for _ in range(2))
        own, first, second = float(rng.integers(0, 3)), after.sum(), ahead.sum()
        size_first, size_second = table.sum(axis=1), table.sum(axis=0)

        def value(t, a, b):
            return sum(map(h, t.ravel())) - sum(map(h, a)) - sum(map(h, b))

        want = []
        for c in range(classes):
            t, a, b = table.copy(), size_first.copy(), size_second.copy()
            t[c] += after
            t[:, c] += ahead
            t[c, c] += own
            a[c] += first
            b[c] += second
            want.append(value(t, a, b) - value(table, size_first, size_second))
        got = lm_scoring.gains(table, size_first, size_second, after, ahead, own, first, second, classes)
        assert got == pytest.approx(np.array(want))


def corpus():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    texts = [" ".join(rng.choices(vocabulary, weights, k=rng.randrange(0, 25))) + (f" once{i}" if i % 4 == 0 else "") for i in range(200)]
    return texts + [None, "", "w1 w1 w1"]


@pytest.mark.parametrize("known_most,e", [(15, 4), (1000, 4), (15, 0)])
def test_neighbours_are_counted_once(spark, known_most, e):
    texts = corpus()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    vocabulary = lm_scoring.count_words(df, "text").persist()
    known, counts, first_step = lm_scoring.known_words(vocabulary, known_most)
    tail = vocabulary.where((F.col("word") != lm_scoring.END) & (lm_scoring._step(F.col("n")) < first_step) & (F.col("n") > 1))
    tail = lm_scoring.numbered_tail(tail, len(known)) if tail.count() else None
    near = lm_scoring.neighbours(lm_scoring.encode(df, "text", known), counts, tail, e)
    got = {r["word"]: (r["n"], dict(zip(r["codes"], r["times"]))) for r in near.collect()}
    held = Counter(w for t in texts for w in words(t))
    order = sorted((w for w in held if held[w] > 1), key=lambda w: (-held[w], w))
    number = {w: i for i, w in enumerate(order)} | {"\n": lm_scoring._END}
    want = {number[w]: (held[w], Counter()) for w in order[e:]}
    for t in texts:
        sequence = ["\n", *words(t), "\n"]
        for a, b in zip(sequence, sequence[1:]):
            if a in number and b in number:
                if number[a] in want:
                    want[number[a]][1][number[b] * 2 + 1] += 1
                if number[b] in want:
                    want[number[b]][1][number[a] * 2] += 1
    assert got == {w: (n, dict(c)) for w, (n, c) in want.items()}
    vocabulary.unpersist()


def test_counts_under_classes_equal_loops(spark):
    texts = corpus()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    vocabulary = lm_scoring.count_words(df, "text").persist()
    known, counts, _ = lm_scoring.known_words(vocabulary, 1000)
    e, k, classes = 6, len(known), 5
    encoded = lm_scoring.encode(df, "text", known)
    rng = np.random.default_rng(1)
    of = np.concatenate((rng.integers(0, classes, k), [classes + 1])).astype(np.uint8)
    width = classes + 2
    number = {w: i for i, w in enumerate(known)}
    cls = lambda w: width - 1 if w == "\n" else int(of[number[w]]) if w in number else classes
    table, moves = np.zeros((e + 2, e + 2), dtype=np.int64), np.zeros((width, width), dtype=np.int64)
    around = np.zeros((e, 2 * width + 1), dtype=np.int64)
    for t in texts:
        sequence = ["\n", *words(t), "\n"]
        for a, b in zip(sequence, sequence[1:]):
            small = [e + 1 if w == "\n" else min(number.get(w, e), e) for w in (a, b)]
            table[small[0], small[1]] += 1
            moves[cls(a), cls(b)] += 1
            if small[0] < e:
                around[small[0], width + cls(b)] += 1
                around[small[0], 2 * width] += a == b
            if small[1] < e:
                around[small[1], cls(a)] += 1
    near = lm_scoring.neighbours(encoded, counts, None, e)
    tokens = sum(len(words(t)) + 1 for t in texts)
    state = lm_scoring.counted(near, of, table, counts, tokens, len(texts))
    others = np.arange(width) != classes
    assert (state.moves[np.ix_(others, others)] == moves[np.ix_(others, others)]).all()
    assert (state.moves.sum(axis=1) == state.sizes).all() and (state.moves.sum(axis=0) == state.sizes).all()
    assert (state.sizes == moves.sum(axis=0)).all() and (state.around == around).all()
    # the exchange of the first words leaves the counts that a new count gives
    moved = lm_scoring.exchanged_first(state, table, counts)
    again = lm_scoring.counted(near, moved.classes, table, counts, tokens, len(texts))
    assert (moved.classes[e:] == of[e:]).all() and (moved.classes[:e] != of[:e]).any()
    for name in ("around", "moves", "sizes", "raw"):
        assert (getattr(moved, name) == getattr(again, name)).all(), name
    assert moved.likelihood() > state.likelihood()
    vocabulary.unpersist()


def test_words_beyond_the_sweeps_have_classes_too(spark):
    rng = random.Random(3)
    left, right = [f"l{i}" for i in range(30)], [f"r{i}" for i in range(30)]
    rows = [(i, " ".join(w for _ in range(rng.randrange(1, 30)) for w in (rng.choice(left), rng.choice(right)))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    train = lm_scoring.trained(F.col("doc_id"))
    by = lambda **o: {r["id"]: r for r in lm_scoring.lm_scores(df, train, classes=2, exchange_words=8, **o).collect()}
    every, some, joined = by(), by(swept=20), by(swept=20, known_most=30)
    for i in every:
        assert some[i]["base_score"] == pytest.approx(every[i]["base_score"]) and some[i]["n_known"] == every[i]["n_known"]
        assert joined[i]["score"] == pytest.approx(some[i]["score"])
    assert sum(r["score"] for r in some.values()) > sum(r["base_score"] for r in some.values())


def test_all_bigrams_are_counted_with_words_beyond_the_sweeps(spark):
    texts = corpus()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    vocabulary = lm_scoring.count_words(df, "text").persist()
    known, counts, _ = lm_scoring.known_words(vocabulary, 1000)
    encoded = lm_scoring.encode(df, "text", known)
    tokens, types = sum(len(words(t)) + 1 for t in texts), vocabulary.count()
    model, _ = lm_scoring.fit_words(encoded, counts, None, tokens, types, len(texts), 4, 6, swept=20)
    width = len(model.moves)
    cls = {w: model.classes[i] for i, w in enumerate(known)} | {"\n": width - 1}
    moves = np.zeros((width, width))
    for t in texts:
        sequence = ["\n", *words(t), "\n"]
        for a, b in zip(sequence, sequence[1:]):
            moves[cls.get(a, width - 2), cls.get(b, width - 2)] += 1
    sizes = moves.sum(axis=0)
    assert (model.sizes == sizes).all()
    share = (sizes + 1) / (sizes.sum() + width)
    want = (moves + lm_scoring.TRANSITION_MASS * share) / (moves.sum(axis=1, keepdims=True) + lm_scoring.TRANSITION_MASS)
    assert 10 ** model.moves == pytest.approx(want)
    vocabulary.unpersist()


def test_registered_query_beats_its_base_on_held_out_texts(spark):
    rows = op8_lm_scoring(spark, SF001).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()}
    assert len(rows) == len(docs)
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    counts = Counter(w for d, t in docs.items() if zlib.crc32(str(d).encode()) % 7 != 2 for w in [*words(lower(t)), "\n"])
    total, types = sum(counts.values()), len(counts)
    for r in rows:
        tokens = [*words(lower(docs[r["doc_id"]])), "\n"]
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(counts[w] > 0 for w in tokens), total)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (total + types + 1)) for w in tokens))
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB \t\n\x0b\x0c\r\x1c\x1f\x85 éÉ日", max_size=12)), max_size=6), st.integers(0, 2), st.booleans())
def test_numbered_words_are_the_words(texts, skipped, lower):
    column = pa.array(["X y"] * skipped + texts, pa.string()).slice(skipped)
    flat, counts = text.words_of(text.utf8(column, lower))
    different, at, got = text.numbered_words(column, lower)
    each = text.bytes_of(different)
    assert [each[i] for i in at] == flat and got.tolist() == counts.tolist() and sorted(each) == sorted(set(flat))


def test_entries_travel_as_a_row_a_word(monkeypatch):
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 20, 5000) << 32 | rng.integers(0, 30, 5000)
    times = rng.integers(1, 1 << 33, 5000)
    monkeypatch.setattr(lm_scoring, "MOST_COUNTED", 2000)
    for each in (None, times):
        parts = [(keys[a:a + 500], None if each is None else each[a:a + 500]) for a in range(0, 5000, 500)]
        rows, got = 0, Counter()
        for batch in lm_scoring._counted(iter(parts)):
            batch = batch.slice(1) if rows else batch  # a slice starts later in its bytes
            rows += batch.num_rows
            codes, starts = lm_scoring._numbers_of(batch.column(1), "<u4")
            word = np.repeat(batch.column(0).to_numpy(), np.diff(starts))
            for w, c, n in zip(word.tolist(), codes.tolist(), lm_scoring._numbers_of(batch.column(2), "<i8")[0].tolist()):
                got[w, c] += n
        want = Counter()
        for n, (k, t) in enumerate(zip(keys.tolist(), times.tolist() if each is not None else [1] * 5000)):
            if n < 2500 or k >> 32:  # the slices left out word 0
                want[k >> 32, k & lm_scoring._OWN] += t
        assert rows <= 2 * 20 and got == want
