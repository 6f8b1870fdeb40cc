"""Cross-tokenizer alignment against sets of ends, counted and written out by hand."""

import bisect
import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskfold.llm import alignment
from riskfold.llm.queries import op12_token_alignment, tokenizer_file
from tests.conftest import SF001
from tests.llm.fixtures import edge_docs, edge_rows


@pytest.fixture(scope="module")
def both():
    return alignment.Tokenizers(tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


def plain(both, text):
    """(n_a, n_b, digest, linked pairs) with the libraries' own calls on the whole text."""
    a, b = both.load().both
    none = (0, 0, "", [])
    if not text:
        return none
    spaced = (" " + text).encode()
    x = a.tokenizer.encode(" " + text, add_special_tokens=False).ids
    y = b.model.encode(text)
    if b"".join(a.bytes[i] for i in x) != spaced or b"".join(b.bytes[i] for i in y) != spaced:
        return none
    ends_x, ends_y = (np.cumsum([len(t.bytes[i]) for i in ids]).tolist() for t, ids in ((a, x), (b, y)))
    common = sorted(set(ends_x) & set(ends_y))
    group_x, group_y = ([[] for _ in common] for _ in range(2))
    for i, e in zip(x, ends_x):
        group_x[bisect.bisect_left(common, e)].append(i)
    for i, e in zip(y, ends_y):
        group_y[bisect.bisect_left(common, e)].append(i)
    string = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in zip(group_x, group_y))
    return len(x), len(y), hashlib.sha256(string.encode()).hexdigest(), [(p[-1], q[-1]) for p, q in zip(group_x, group_y)]


def corpus(both, texts):
    """The query's columns but the id for each text, from counts over all of them."""
    each = [plain(both, t) for t in texts]
    counts = Counter(link for *_, links in each for link in links)
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [
        (n_a, n_b, len(links), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), digest)
        for n_a, n_b, digest, links in each]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    " ", "  ", "a ", " a", "a  b", "\n", "a\n b", "a \n  b\n\n", "\x1ca \x85b　c d", "▁", "x ▁y", "<|endoftext|>", "<s> </s><unk><0x41>",
    "I'm we'll they've  'tis", "0 00 1234567 ½ ²", "\x00 \x7f", "ﬁ Å Å é", "世界 世 界", "\U0001f600\U0001f468‍\U0001f469", "a" * 3000,
    " " * 3000 + "x", "ab " * 1000, "\t\t x\t y",
]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=80), st.lists(st.integers(1, 4), max_size=80), st.booleans())
def test_runs_are_the_common_ends(a, b, alike):
    if alike:  # mostly one to one
        b = a[:]
        for i in range(7, len(b), 9):
            b[i - 1:i + 1] = [sum(b[i - 1:i + 1])]
    got = alignment.runs(np.array(a, dtype=np.uint8), np.array(b, dtype=np.uint8))
    ends_a, ends_b = np.cumsum(a).tolist(), np.cumsum(b).tolist()
    pairs = [(i + k, j + k) for i, j, n in zip(*got) for k in range(n)]
    assert pairs == [(ends_a.index(e), ends_b.index(e)) for e in sorted(set(ends_a) & set(ends_b))]
    for (i, j, n), (i2, j2) in zip(zip(*got), zip(got[0][1:], got[1][1:])):
        assert (i + n, j + n) != (i2, j2)  # maximal


def test_odd_texts_equal_whole_text_encoding(spark, both):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "doc_id long, text string").repartition(3)
    rows = alignment.aligned_scores(docs, both).collect()
    want = corpus(both, ODD)
    assert sorted((r["id"], *[r[c] for c in COLUMNS]) for r in rows) == [(i, *w) for i, w in enumerate(want)]
    assert sum(w[0] == 0 for w in want) == 2  # those with U+2581


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab 'é世\U0001f600\n\t\x85▁0.<s>", max_size=40), min_size=1, max_size=5))
def test_segments_equal_whole_text_encoding(both, texts):
    coder = both.load()
    a, b = coder.both
    (flat_a, n_a), (flat_b, n_b) = coder([t.encode() for t in texts])
    at = [0, 0]
    for t, x, y in zip(texts, n_a.tolist(), n_b.tolist()):
        want = plain(both, t)
        assert (x, y) == want[:2]
        if x:
            assert flat_a[at[0]:at[0] + x].tolist() == a.tokenizer.encode(" " + t, add_special_tokens=False).ids
            assert flat_b[at[1]:at[1] + y].tolist() == b.model.encode(t)
        at = [at[0] + x, at[1] + y]


def test_edge_rows_and_empty_tables(spark, both):
    docs = edge_docs(spark)
    rows = alignment.aligned_scores(docs, both).collect()
    texts = [r[1] for r in edge_rows()]
    want = sorted((str(r[0]), *w) for r, w in zip(edge_rows(), corpus(both, texts)))
    assert sorted((str(r["id"]), *[r[c] for c in COLUMNS]) for r in rows) == want
    assert alignment.aligned_scores(docs.where("false"), both).count() == 0
    assert alignment.aligned_scores(docs.where("text is null"), both).agg(F.sum("n_a")).first()[0] == 0


def test_groups_are_given_whole(spark, both):
    docs = spark.createDataFrame([(1, "Ertion thhehees 世界 antidisestablish")], "doc_id long, text string")
    r = alignment.align(docs, both, with_groups=True).first()
    assert len(r["group_a"]) == len(r["group_b"]) == r["n_groups"] == len(r["links"])
    assert sum(r["group_a"]) == r["n_a"] and sum(r["group_b"]) == r["n_b"]


def test_forgotten_segments_change_nothing(both, monkeypatch):
    texts = [t.encode() for t in ODD]
    coder = alignment.Coder(*both.load().both)
    want = coder(texts)
    monkeypatch.setattr(alignment, "MOST_SEGMENTS", 3)
    monkeypatch.setattr(alignment, "TOGETHER", 2)
    for _ in range(3):
        for (x, n), (y, m) in zip(coder(texts), want):
            assert x.tolist() == y.tolist() and n.tolist() == m.tolist()


def test_a_piece_looks_up_each_segment_once(both):
    looked_up = []

    class Counted(alignment.Numbers):
        def __getitem__(self, key):
            looked_up.append(key)
            return super().__getitem__(key)

    coder = alignment.Coder(*both.load().both)
    texts = [("one two one\n two  one " * 50).encode(), b"two one", b"", b" one"] * 20
    want = [(x.tolist(), n.tolist()) for x, n in coder(texts)]
    coder.numbers = Counted(coder.numbers)
    assert [(x.tolist(), n.tolist()) for x, n in coder(texts)] == want
    assert len(looked_up) == len(set(looked_up)) == len(coder.numbers)


def test_segments_met_again_are_not_encoded_again(both, monkeypatch):
    coder = alignment.Coder(*both.load().both)
    learn, learned = coder._learn, []
    monkeypatch.setattr(coder, "_learn", lambda segments: (learned.append(len(segments)), learn(segments)))
    texts = [" ".join(f"w{i}" for i in range(lo, lo + 5_000)).encode() for lo in range(0, 80_000, 5_000)]
    want = [coder([t])[0][0].tolist() for t in texts]
    assert sum(learned) == 80_000
    assert [coder([t])[0][0].tolist() for t in texts] == want and sum(learned) == 80_000


def test_every_link_is_a_linkable_pair(both):
    coder = both.load()
    a, b = coder.both
    pairs = alignment.linkable(a.bytes, b.bytes)
    assert len(pairs) == len(np.unique(pairs)) <= sum(map(len, a.bytes)) * 2 + sum(map(len, b.bytes))
    for code in pairs[:: len(pairs) // 500].tolist():
        x, y = a.bytes[code // len(b.bytes)], b.bytes[code % len(b.bytes)]
        assert x.endswith(y) or y.endswith(x)


def test_a_text_larger_than_a_piece(spark, both):
    text = " ".join(f"word{i % 977} étude{i % 31}.\n" for i in range(160_000))
    assert len(text) > alignment.PIECE_BYTES
    docs = spark.createDataFrame([(1, text), (2, "word1")], "doc_id long, text string")
    rows = {r["id"]: r for r in alignment.align(docs, both).collect()}
    want = plain(both, text)
    assert (rows[1]["n_a"], rows[1]["n_b"], rows[1]["groups_sha256"]) == want[:3] and rows[1]["n_groups"] == len(want[3])


def test_registered_query_equals_counts_by_hand(spark, both):
    rows = op12_token_alignment(spark, SF001).collect()
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    want = corpus(both, [r["text"] for r in docs])
    assert sorted((r["doc_id"], *[r[c] for c in COLUMNS]) for r in rows) == sorted((r["doc_id"], *w) for r, w in zip(docs, want))
