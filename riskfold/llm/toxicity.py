"""Toxicity: a linear-chain conditional random field over tokens.

Documents are labelled, tokens are not: in toxic documents of the training
sample, the tokens of which a unit (the word, or its first characters) occurs
in a far larger share of the toxic than of the clean documents are labelled
toxic, all other tokens clean.  The field has two states, features on the
units of the word and of its two neighbours, and learned transitions;
forward-backward gives each token's marginal.  A document's score is a
logistic function, fitted on the sample, of its summed-up marginals; runs of
tokens with a marginal of one half and more are the offending offsets.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskfold.llm.ngram_join import gram_sets
from riskfold.llm.text import Numbers, annotate, starts_of, utf8, words_of

#: The field is fitted on at most so many documents of each label, of at most
#: so many characters each.  Scoring takes whole texts of any length.
SAMPLE_DOCS = 1000
SAMPLE_CHARS = 8_000
#: Units of a word: itself, and its first characters. Units with weights of
#: their own are in so many sample documents at least, and so many at most.
PREFIXES = (4, 5, 6)
LEAST_DOCS = 4
MOST_UNITS = 50_000
#: A unit marks toxic tokens if it is in so many toxic documents, and such a
#: share of them, at least, and this many times likelier in them.
TOXIC_DOCS = 5
TOXIC_SHARE = 0.02
TOXIC_RATIO = 10.0
ROUNDS = 40

RESULT = T.StructType([
    T.StructField("score", T.DoubleType(), False),
    T.StructField("expected", T.DoubleType(), False),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType(), False), T.StructField("end", T.LongType(), False),
    ]), False), False),
])
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def held_out(doc_id: Column) -> Column:
    """Rows whose CRC-32 of the id as text leaves no remainder by 5; a null id is the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


class Lattice:
    """Tokens of many texts laid out by time step, longest text first, so that a step is a slice."""

    def __init__(self, counts: np.ndarray):
        by = np.argsort(-counts, kind="stable")
        self.steps = np.searchsorted(-counts[by], -np.arange(int(counts.max(initial=0))), side="left")
        self.begin = starts_of(self.steps)
        rank = np.empty(len(counts), dtype=np.int64)
        rank[by] = np.arange(len(counts))
        starts = starts_of(counts)
        step = np.arange(starts[-1]) - np.repeat(starts[:-1], counts)
        self.place = self.begin[step] + np.repeat(rank, counts)  # of each token, in text order


def forward_backward(lattice: Lattice, odds: np.ndarray, moves: np.ndarray):
    """State odds before and after each token, by place: ``alpha`` and ``beta`` of toxic against clean.

    ``odds``: each token's own odds by place.  ``moves[i, j]``: weight of state j after i.
    """
    (oo, ot), (to, tt) = moves
    alpha, beta = np.empty_like(odds), np.ones_like(odds)
    begin, steps = lattice.begin, lattice.steps
    for t, k in enumerate(steps.tolist()):
        lo = begin[t]
        if t:
            r = alpha[begin[t - 1]: begin[t - 1] + k]
            alpha[lo: lo + k] = (ot + r * tt) / (oo + r * to) * odds[lo: lo + k]
        else:
            alpha[lo: lo + k] = odds[lo: lo + k]
    for t in range(len(steps) - 2, -1, -1):
        k, lo = steps[t + 1], begin[t + 1]
        s = odds[lo: lo + k] * beta[lo: lo + k]
        beta[begin[t]: begin[t] + k] = (to + tt * s) / (oo + ot * s)
    return alpha, beta


def units_of(words) -> list[list]:
    """For each kind of unit, that of every lower-cased word.

    A word that is shorter than a prefix gives itself; units of that kind and
    length are never counted.
    """
    texts = [w.decode() for w in words]
    return [texts, *[[t[:k] for t in texts] for k in PREFIXES]]


@dataclass
class Field:
    """The fitted field: unit numbers (0: none), weights and the document's logistic function."""

    units: list[dict[str, int]]  # by kind; unit 0: none
    bias: float
    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    moves: np.ndarray  # logarithms
    document: np.ndarray  # weights of 1 and of the document's features

    def table(self, words) -> np.ndarray:
        """The unit numbers of each word, in a row of fixed width."""
        each = zip(self.units, units_of(words))
        return np.stack([np.fromiter(map(d.get, u, repeat(0)), dtype=np.int64, count=len(u)) for d, u in each], axis=1)

    def marginals(self, words: np.ndarray, table: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Each token's probability of being toxic, in text order; ``words``: rows of ``table``."""
        if not len(words):
            return np.zeros(0)
        lattice = Lattice(counts)
        odds = np.empty(len(words))
        odds[lattice.place] = np.exp(np.clip(self.logits(words, table, counts), -30, 30))
        alpha, beta = forward_backward(lattice, odds, np.exp(self.moves))
        both = alpha * beta
        return (both / (1 + both))[lattice.place]

    def logits(self, words: np.ndarray, table: np.ndarray, counts: np.ndarray) -> np.ndarray:
        before, after = _neighbours(words, counts, len(table))
        weights = [np.append(w[table].sum(axis=1), 0.0) for w in (self.own, self.before, self.after)]
        return self.bias + weights[0][words] + weights[1][before] + weights[2][after]

    def scores(self, marginals: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        features = document_features(marginals, counts)
        return 1 / (1 + np.exp(-np.clip(features @ self.document, -30, 30))), features[:, 1]


def _neighbours(words: np.ndarray, counts: np.ndarray, none: int) -> tuple[np.ndarray, np.ndarray]:
    """The word before and after each; ``none`` at a text's ends."""
    starts = starts_of(counts)
    before = np.concatenate(([none], words[:-1]))
    after = np.concatenate((words[1:], [none]))
    has = counts > 0
    before[starts[:-1][has]] = none
    after[starts[1:][has] - 1] = none
    return before, after


def document_features(marginals: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """1, the expected number of toxic tokens, its logarithm, the chance of any, and the largest marginal."""
    starts = starts_of(counts)
    total = np.concatenate(([0.0], np.cumsum(marginals)))
    expected = total[starts[1:]] - total[starts[:-1]]
    none = np.concatenate(([0.0], np.cumsum(np.log1p(-np.minimum(marginals, 1 - 1e-12)))))
    chance = 1 - np.exp(none[starts[1:]] - none[starts[:-1]])
    top = np.zeros(len(counts))
    np.maximum.at(top, np.repeat(np.arange(len(counts)), counts), marginals)
    return np.stack([np.ones(len(counts)), np.maximum(expected, 0), np.log1p(np.maximum(expected, 0)), chance, top], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic regression, by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def without_copies(texts: list[bytes], sketch: int = 8) -> list[int]:
    """Positions of texts that share none of their ``sketch`` smallest word 5-grams with an earlier one.

    A text with many copies would make each of its words look like a mark of
    its label.
    """
    grams, sizes = gram_sets(texts)
    starts, seen, kept = starts_of(sizes), set(), []
    for i, (a, b) in enumerate(zip(starts[:-1], starts[1:])):
        low = grams[a:min(b, a + sketch)].tolist()
        if seen.isdisjoint(low):
            kept.append(i)
        seen.update(low)
    return kept


def numbered(flat: list[bytes]) -> tuple[np.ndarray, Numbers]:
    """The tokens as numbers of their different words, and these words."""
    numbers = Numbers()
    return np.fromiter(map(numbers.__getitem__, flat), dtype=np.int64, count=len(flat)), numbers


def fit_field(texts: list[bytes], toxic: np.ndarray, prior: float, rounds: int = ROUNDS) -> Field:
    """The field of a labelled sample; ``prior``: share of toxic documents where they come from."""
    kept = without_copies(texts)
    texts, toxic = [texts[i] for i in kept], toxic[kept]
    flat, counts = words_of(texts)
    words, different = numbered(flat)
    text = np.repeat(np.arange(len(texts)), counts)
    kinds = (0, *PREFIXES)
    units = [[(k, u) for k, u in zip(kinds, row) if len(u) >= k] for row in zip(*units_of(different))]
    in_toxic, in_clean = Counter(), Counter()
    for own, is_toxic in zip(np.split(words, starts_of(counts)[1:-1]), toxic):
        (in_toxic if is_toxic else in_clean).update({u for w in np.unique(own).tolist() for u in units[w]})
    n_toxic, n_clean = max(1, int(toxic.sum())), max(1, int((1 - toxic).sum()))
    often = sorted((u for u in in_toxic.keys() | in_clean.keys() if in_toxic[u] + in_clean[u] >= LEAST_DOCS),
                   key=lambda u: (-in_toxic[u] - in_clean[u], u))[:MOST_UNITS]
    bad = np.array([False] + [
        in_toxic[u] >= max(TOXIC_DOCS, TOXIC_SHARE * n_toxic)
        and in_toxic[u] / n_toxic >= TOXIC_RATIO * (in_clean[u] + 1) / n_clean for u in often])
    k = len(often) + 1
    numbers = [{u: i for i, (own, u) in enumerate(often, 1) if own == kind} for kind in kinds]
    field = Field(numbers, 0.0, *np.zeros((3, k)), np.zeros((2, 2)), np.zeros(5))
    table = field.table(different)
    gold = (bad[table].any(axis=1)[words] & (toxic[text] > 0)).astype(float) if len(words) else np.zeros(0)
    if gold.any():
        _train(field, words, table, counts, gold, rounds)
    else:
        field.bias = -20.0
    x = document_features(field.marginals(words, table, counts), counts)
    # the sample holds more toxic documents than the rows do: the constant is moved by the odds
    field.document = _logistic(x, toxic.astype(float))
    share = np.clip(toxic.mean() if len(toxic) else 0.5, 1e-6, 1 - 1e-6)
    prior = float(np.clip(prior, 1e-6, 1 - 1e-6))
    field.document[0] += np.log(prior / (1 - prior)) - np.log(share / (1 - share))
    return field


def _train(field: Field, words, table, counts, gold, rounds: int, rate: float = 0.3, ridge: float = 1e-3) -> None:
    """Adam on the conditional log-likelihood of the tokens' labels."""
    lattice, k, n = Lattice(counts), len(field.own), len(words)
    before, after = _neighbours(words, counts, len(table))
    place, begin, steps = lattice.place, lattice.begin, lattice.steps
    y = np.empty(n)
    y[place] = gold
    # each place's place one step earlier, for all but a text's first token
    later = np.arange(begin[1], begin[-1]) if len(steps) > 1 else np.zeros(0, dtype=np.int64)
    step = np.repeat(np.arange(1, len(steps)), steps[1:])
    earlier = later - begin[step] + begin[step - 1] if len(later) else later
    field.bias = float(np.log(gold.mean() / (1 - gold.mean())))
    params = np.concatenate(([field.bias], np.zeros(3 * k + 3)))
    m, v = np.zeros_like(params), np.zeros_like(params)

    def put(p):
        # unit 0 stands for none
        field.bias, (field.own, field.before, field.after) = p[0], p[1:-3].reshape(3, k) * (np.arange(k) > 0)
        field.moves = np.array([[0.0, p[-3]], [p[-2], p[-1]]])

    def by_unit(at, wrong):
        """Sums of ``wrong`` by unit of the words ``at``."""
        each = np.bincount(at, wrong, len(table) + 1)[:-1]
        return np.bincount(table.ravel(), np.repeat(each, table.shape[1]), k)

    for r in range(1, rounds + 1):
        put(params)
        odds = np.empty(n)
        odds[place] = np.exp(np.clip(field.logits(words, table, counts), -30, 30))
        w = np.exp(field.moves)
        alpha, beta = forward_backward(lattice, odds, w)
        p = alpha * beta / (1 + alpha * beta)
        wrong = (y - p)[place]
        s, a = odds[later] * beta[later], alpha[earlier]
        pair = np.stack([np.full(len(later), w[0, 0]), w[0, 1] * s, a * w[1, 0], a * w[1, 1] * s])
        pair /= pair.sum(axis=0)
        ya, yb = y[earlier], y[later]
        moves = [((1 - ya) * yb - pair[1]).sum(), (ya * (1 - yb) - pair[2]).sum(), (ya * yb - pair[3]).sum()]
        grad = np.concatenate((
            [wrong.sum()], by_unit(words, wrong), by_unit(before, wrong), by_unit(after, wrong), moves,
        )) / n - ridge * np.concatenate(([0.0], params[1:])) / max(1.0, gold.sum())
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad ** 2
        params = params + rate * (m / (1 - 0.9 ** r)) / (np.sqrt(v / (1 - 0.999 ** r)) + 1e-10)
    put(params)


def fit(
    docs: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS,
) -> Field:
    """Fit on the labelled rows for which ``train`` (of ``id_col``) holds.

    The sample has at most ``sample_docs`` documents of each label, those with
    the smallest hashes of their id, of 1 to ``sample_chars`` characters.
    Null labels and ids are left out; of several labels of an id the largest
    counts.  Without documents of both labels every score is the toxic share.
    """
    marks = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).where(train).groupBy(
        F.col(id_col).alias("id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("toxic"))
    share = marks.agg(F.avg("toxic")).first()[0] or 0.0
    rank = F.xxhash64("id", F.lit("toxicity"))
    # more ids than needed: some have no text, or too long a one
    chosen = [marks.where(F.col("toxic") == t).orderBy(rank, "id").limit(2 * sample_docs) for t in (0, 1)]
    some = chosen[0].unionByName(chosen[1])
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(
        (F.length("text") > 0) & (F.length("text") <= sample_chars)).join(F.broadcast(some), "id")  # 4 x sample_docs ids
    rows = []
    for t in (0, 1):
        rows += texts.where(F.col("toxic") == t).orderBy(rank, "id", "text").limit(sample_docs).select("text", "toxic").collect()
    toxic = np.array([r["toxic"] for r in rows], dtype=np.int64)
    return fit_field([r["text"].encode().lower() for r in rows], toxic, share)


def score(docs: DataFrame, field: Field, text_col: str = "text", into: str = "__toxicity") -> DataFrame:
    """``docs`` with a struct ``into``: ``score`` (0 to 1), ``expected`` toxic tokens, ``spans``.

    Spans are character offsets of the runs of tokens with a marginal of one
    half and more.  Null and empty texts have no tokens and get the score of
    none.  Rows may repeat; all other columns pass through.
    """
    held = docs.sparkSession.sparkContext.broadcast(field)  # MOST_UNITS units and their weights at most

    def make():
        model = held.value

        def spans_of(text: bytes, bad: np.ndarray) -> list[dict]:
            places = [m.span() for m in _WORD.finditer(text)]
            edges = np.flatnonzero(np.diff(np.concatenate(([0], bad.astype(np.int8), [0]))))
            return [{"start": len(text[:places[a][0]].decode()), "end": len(text[:places[b - 1][1]].decode())}
                    for a, b in zip(edges[::2], edges[1::2])]

        def work(texts: pa.Array) -> dict[str, pa.Array]:
            raw = utf8(texts)
            flat, counts = words_of([t.lower() for t in raw])
            words, different = numbered(flat)
            marginals = model.marginals(words, model.table(different), counts)
            scores, expected = model.scores(marginals, counts)
            starts, bad = starts_of(counts), marginals >= 0.5
            hits = np.concatenate(([0], np.cumsum(bad)))
            spans = [
                spans_of(t, bad[a:b]) if hits[b] > hits[a] else []
                for t, a, b in zip(raw, starts[:-1].tolist(), starts[1:].tolist())
            ]
            kind = pa.list_(pa.field("element", pa.struct([
                pa.field("start", pa.int64(), False), pa.field("end", pa.int64(), False)]), False))
            return {"score": pa.array(scores), "expected": pa.array(expected), "spans": pa.array(spans, kind)}

        return work

    return annotate(docs, text_col, into, RESULT, make)
