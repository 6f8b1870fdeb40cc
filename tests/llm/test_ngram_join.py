"""The Jaccard join against brute force: families of near copies, hubs, blocks and hot grams."""

import random

import numpy as np
import pytest

from riskfold.llm import ngram_join as J
from riskfold.llm.components import components
from tests.llm.fixtures import edge_docs, edge_rows, words


def sets_of(text):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """Smallest id reachable by links, by row; rows of (id, text) with unique ids."""
    sets = [sets_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n and 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: (len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)}


def families(seed, n_docs=160):
    """Origins, copies with few or many changed words, chains of copies, and a passage that many share."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    passage = [word() for _ in range(60)]
    texts = []
    while len(texts) < n_docs:
        base = [word() for _ in range(rng.choice([4, 8, 30, 60, 120]))]
        if rng.random() < 0.4:
            base[3:3] = passage
        texts.append(base)
        last = base
        for _ in range(rng.choice([0, 0, 1, 3, 12])):
            last = list(rng.choice([base, last]))  # of the origin, or of the last copy: chains
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                last[rng.randrange(len(last))] = word()
            texts.append(last)
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed,options", [(1, {}), (2, {"block": 7}), (3, {"sample_docs": 40, "block": 20})])
def test_equals_brute_force(spark, monkeypatch, seed, options):
    if seed == 3:
        monkeypatch.setattr(J, "HOT", 2)  # the path of hot grams
    rows = families(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in J.near_duplicates(df, **options).collect()}
    assert got == brute(rows)


@pytest.mark.parametrize("block", [J.BLOCK, 9])
def test_exact_join_lists_every_link(spark, block):
    rng = random.Random(6)
    base = [f"b{i}" for i in range(150)]
    near = []
    for _ in range(40):  # a group of different near copies: far more links than components need
        copy = list(base)
        for _ in range(rng.choice([1, 2, 3])):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(10_000)}"
        near.append(" ".join(copy))
    rows = families(4, 100)
    rows += [(len(rows) + i, t) for i, t in enumerate([*near, near[0], "", None])]
    sets = {d: frozenset(sets_of(t)) for d, t in rows}
    least = {}
    for d in sorted(sets):
        least.setdefault(sets[d], d)
    ids = sorted(d for s, d in least.items() if s)
    want = set()
    for x in ids:
        for y in ids:
            n = len(sets[x] & sets[y])
            if x < y and n and 100 * n >= 80 * (len(sets[x]) + len(sets[y]) - n):
                want.add((x, y))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    _, nodes, links = J.join_sets(df, block=block, exact=True)
    first = {r[J.ROW]: r["first_id"] for r in nodes.collect()}
    got = [tuple(sorted((first[r["a"]], first[r["b"]]))) for r in links.collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 300
    counts = {r["first_id"]: r["n_links"] for r in J.link_counts(nodes, links).collect()}
    assert counts == {d: sum(d in pair for pair in want) for d in ids}


def test_edge_cases(spark):
    rows = [(r[0], r[1]) for r in edge_rows()]
    got = [(r["id"], r["n_shingles"], r["component_id"]) for r in J.near_duplicates(edge_docs(spark)).collect()]
    assert len(got) == len(rows)
    want = brute([(i, t) for i, (_, t) in enumerate(rows)])
    ids = [d for d, _ in rows]
    for i, (d, _) in enumerate(rows):
        n, root = want[i]
        members = [ids[j] for j in want if want[j][1] == root]
        least = min((m for m in members if m is not None), default=None)
        assert (d, n, least) in got
    empty = J.near_duplicates(edge_docs(spark).where("false"))
    assert empty.columns == ["id", "n_shingles", "component_id"] and empty.count() == 0


def test_bound_never_loses_a_link():
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdef") for _ in range(rng.randrange(1, 60))).encode() for _ in range(80)]
    grams, sizes = J.gram_sets(texts)
    vectors = J.count_vectors(grams, sizes)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    sets = [set(grams[a:b].tolist()) for a, b in zip(starts, starts[1:])]
    assert [len(s) for s in sets] == [len(sets_of(t.decode())) for t in texts]
    links = {(i, j) for i in range(80) for j in range(i) if J.allowed(len(sets[i] & sets[j]), sizes[i], sizes[j])}
    tree = J.RTree(vectors, sizes)
    found = {(max(x, y), min(x, y)) for a, b in tree.pairs() for x, y in zip(a.tolist(), b.tolist())}
    assert links <= found
    group = np.arange(80) % 2
    apart = {(max(x, y), min(x, y)) for a, b in tree.pairs(group=group) for x, y in zip(a.tolist(), b.tolist())}
    assert {p for p in found if group[p[0]] != group[p[1]]} == apart
    best = [(x, y) for a, b in tree.pairs(best=2) for x, y in zip(a.tolist(), b.tolist())]
    assert all(sum(x == i for x, _ in best) <= 2 for i in range(80))
    assert {x for x, _ in best} == {x for p in found for x in p}


def test_large_sets_use_wide_counts():
    wide = np.zeros((3, J.GROUPS), dtype=np.int64)
    wide[0, 3], wide[1, 3], wide[2, 3] = 70_000, 5, 300
    packed = J._packed(wide).to_pylist()
    assert [len(b) // J.GROUPS for b in packed] == [4, 1, 2]
    assert (J._unpacked(packed) == wide).all() and (J._unpacked(packed[1:2]) == wide[1]).all()
    assert (J._coarse(wide).sum(axis=1) == wide.sum(axis=1)).all()


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(40)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
