"""The prefix trie against one built in plain Python, and the contraction against recursion."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from riskfold.llm import prefix_trie
from riskfold.llm.queries import op13_prefix_trie
from tests.conftest import SF001

SCHEMA = "conv_id long, turn int, role string, text string"


def plain_trie(rows):
    """All nodes of the rebuilt conversations, by recursion over dictionaries."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        family = int(c - (abs(c) % 5) * (1 if c >= 0 else -1))
        built[c] = tuple(own.get(family, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[b] for b in below) if below else 1
        size = len(node[-1][1].encode()) if node else 0
        saved[node] = (len(members[node]) - 1) * size + sum(saved[b] for b in below)
    out = []
    for node, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if built[c] == node)))
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]), leaves[node], saved[node],
            hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(df):
    out = prefix_trie.prefix_trie(df)
    assert out.columns == COLUMNS
    return sorted((tuple(r) for r in out.collect()), key=str)


def random_rows(seed, convs, turns):
    """Few different texts, so many prefixes are shared; nulls, ties and repeated rows."""
    rng = random.Random(seed)
    rows = []
    for c in convs:
        for t in range(rng.randrange(1, turns)):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "assistant", None, ""]), rng.choice(["a", "é世", "", None, "b:1"])))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,convs,turns", [(1, range(60), 5), (2, range(-12, 13), 12), (3, [0, 1, 2, 3, 4, 10, 11, 17, 10**12], 30)])
def test_trie_equals_plain_python(spark, seed, convs, turns):
    rows = random_rows(seed, convs, turns) + [(None, 1, "user", "no conversation")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"no": F.lit("x"), "key": F.lit(1), "__part": F.lit(2)}).repartition(4)
    assert trie(df) == plain_trie(rows)


def test_one_conversation_with_most_rows_and_many_copies(spark):
    """One conversation of many turns lies in many ranges; a third of all conversations are copies."""
    rows = [(5, t, "user", f"turn {t}") for t in range(700)]
    rows += [(5000 + 5 * c, t, "user", f"copy {t}") for c in range(200) for t in range(3)]
    rows += [(7, t, "user", f"turn {t}") for t in range(650)] + [(9, 0, "user", "turn 0"), (9, 1, "user", "other")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert trie(df) == plain_trie(rows)


def test_a_member_list_longer_than_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    rows = [(10 * c, 0, "user", "same") for c in range(100)]
    assert trie(spark.createDataFrame(rows, SCHEMA)) == plain_trie(rows)


def test_conversations_without_turns_are_members_of_the_root(spark):
    # 10**6 + 1 has no first conversation in its family, and fewer turns than it would share
    rows = [(c, 0, "user", "x") for c in range(1, 200, 5)]
    got = trie(spark.createDataFrame(rows, SCHEMA))
    assert got == plain_trie(rows)
    root = next(r for r in got if r[1] == 0)
    assert root[3] == len(rows) and root[7] != hashlib.sha256().hexdigest()


def test_no_conversations_no_nodes(spark):
    df = spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)
    assert trie(df) == [] and trie(df.where("false")) == []


def test_a_very_long_text_counts_whole(spark):
    long = "é" * 5_000_000
    rows = [(0, 0, "user", long), (4, 0, "user", long), (4, 1, "user", "x"), (2, 0, "a", "b")]
    assert trie(spark.createDataFrame(rows, SCHEMA)) == plain_trie(rows)


def trees():
    rng = random.Random(5)
    yield "path", {i: i - 1 if i else None for i in range(300)}
    yield "star", {i: 0 if i else None for i in range(200)}
    yield "random", {i: rng.randrange(i) if i else None for i in range(300)}
    yield "caterpillar", {i: (i - 2 if i % 2 == 0 else i - 1) if i else None for i in range(200)}
    yield "binary", {i: (i - 1) // 2 if i else None for i in range(255)}
    broom = {i: i - 1 if i else None for i in range(100)}
    yield "broom and forest", broom | {100 + i: 99 for i in range(50)} | {1000 + i: (999 + i if i else None) for i in range(60)} | {5000: None}


@pytest.mark.parametrize("name,parents", list(trees()), ids=[n for n, _ in trees()])
def test_contraction_gives_every_subtree_total(spark, name, parents):
    total, one = Counter(), Counter()
    for v in parents:
        u = v
        while u is not None:
            total[u] += v * v + 1
            one[u] += 1
            u = parents[u]
    key = lambda i: None if i is None else i.to_bytes(4, "big")
    nodes = spark.createDataFrame([(key(i), key(p), i * i + 1, 1) for i, p in parents.items()], "key binary, parent binary, x long, y long")
    got = {int.from_bytes(r["key"], "big"): (r["x"], r["y"]) for r in prefix_trie.subtree_sums(nodes, ["x", "y"]).collect()}
    assert got == {i: (total[i], one[i]) for i in parents}


def test_numbers_do_not_depend_on_the_ranges(spark):
    rows = [(c, t) for c in range(3) for t in range(200 if c == 1 else 5)] * 2
    df = spark.createDataFrame(rows, "conv long, turn long").repartition(5)
    got = sorted((r["conv"], r["turn"], r["no"]) for r in prefix_trie.numbered(df, "conv", ["turn"], "test").collect())
    seen, want = Counter(), []
    for c, t in sorted(rows):
        want.append((c, t, seen[c]))
        seen[c] += 1
    assert got == want


def test_registered_query_equals_plain_python(spark):
    rows = spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    got = sorted((tuple(r[c] for c in COLUMNS) for r in op13_prefix_trie(spark, SF001).collect()), key=str)
    assert got == plain_trie([tuple(r) for r in rows])
