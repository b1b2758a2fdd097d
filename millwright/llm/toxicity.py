"""Toxic spans by a linear-chain conditional random field, summed up to document scores.

Words (maximal runs of ASCII letters and bytes above 127, A-Z folded) are tagged toxic or
not; a chain is one line of a text. Labelled tokens come from labelled documents: words and
word beginnings that occur in toxic documents almost only mark their tokens there. The field
has weights for the word, its beginnings of 4 to 6 bytes, its last 3 bytes and the four
transitions. Its marginals by forward-backward give the offsets, and two sums of them the
score of a document by logistic regression.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.language import CHAIN_BYTES, held_out
from millwright.llm.text import FOLDED_VALUES, Prefix, buffers, mix, runs, sliced

#: Labelled rows that the model is fitted on at most, per class: the first by a hash of the id.
TOXIC_ROWS = 2000
CLEAN_ROWS = 2000
SLOT_BITS = 18
PURITY = 0.98
ROUNDS = 40
TRAIN_CHAIN = 64
SPAN_CHANCE = 0.5
THRESHOLD = 0.3
KINDS = 5

WORD = np.zeros(256, dtype=bool)
WORD[ord("A") : ord("Z") + 1] = WORD[ord("a") : ord("z") + 1] = WORD[128:] = True


@dataclass
class Tokens:
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    #: [token, kind]: hashed features; 0 where the word is too short for the kind.
    features: np.ndarray
    #: First token of every chain, and one entry more.
    chains: np.ndarray
    data: np.ndarray
    offsets: np.ndarray


def tokens_of(column: pa.Array) -> Tokens:
    data, offsets = buffers(column)
    row, start, end = runs(WORD[data], offsets)
    prefix = Prefix(FOLDED_VALUES[data])
    columns = [prefix.hash(start, end)]
    for k in (4, 5, 6):
        columns.append(np.where(end - start >= k, prefix.hash(start, np.minimum(start + k, end)), 0))
    columns.append(np.where(end - start >= 4, prefix.hash(np.maximum(end - 3, start), end), 0))
    features = np.stack([np.where(c == 0, 0, mix(c + np.uint64(k + 1))) for k, c in enumerate(columns)], axis=1)
    line = np.cumsum(data == 10)
    line = line[start] if len(start) else start
    fresh = np.ones(len(row), dtype=bool)
    fresh[1:] = (row[1:] != row[:-1]) | (line[1:] != line[:-1])
    return Tokens(row, start, end, features, np.append(np.flatnonzero(fresh), len(row)), data, offsets)


# ------------------------------------------------------------------ the field
def marginal_odds(emission: np.ndarray, chains: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token: log odds of being toxic, forward log odds (own emission included), backward log odds.

    ``emission`` are log odds, ``transition[a, b]`` the log weight of tag b after a. With two
    tags a chain's messages are one number each. Longest chains first, a step handles all
    chains still open.
    """
    length = np.diff(chains)
    order = np.argsort(-length, kind="stable")
    first, length = chains[:-1][order], length[order]
    steps = int(length[0]) if len(length) else 0
    open_at = np.searchsorted(-length, -np.arange(steps), side="left")
    m = np.exp(transition)
    forward, backward = np.empty(len(emission)), np.zeros(len(emission))
    state = np.zeros(0)
    for t in range(steps):
        at = first[: open_at[t]] + t
        if t:
            odds = np.exp(state[: open_at[t]])
            state = np.log((m[0, 1] + m[1, 1] * odds) / (m[0, 0] + m[1, 0] * odds)) + emission[at]
        else:
            state = emission[at]
        state = np.clip(state, -60, 60)
        forward[at] = state
    back = np.zeros(len(length))
    for t in range(steps - 2, -1, -1):
        k = open_at[t + 1]
        at = first[:k] + t
        odds = np.exp(np.clip(back[:k] + emission[at + 1], -60, 60))
        back[:k] = np.log((m[1, 0] + m[1, 1] * odds) / (m[0, 0] + m[0, 1] * odds))
        backward[at] = back[:k]
    return forward + backward, forward, backward


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def lexicon(features: np.ndarray, row: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Features of toxic documents almost only: those that explain documents no better one does, and very frequent ones."""
    names, code = np.unique(features.ravel(), return_inverse=True)
    both = np.unique(code.ravel().astype(np.int64) * len(toxic) + np.repeat(row, features.shape[1]))
    pair = np.stack(np.divmod(both, len(toxic)), axis=1)
    pair = pair[names[pair[:, 0]] != 0]
    bad = np.bincount(pair[toxic[pair[:, 1]], 0], minlength=len(names))
    every = np.bincount(pair[:, 0], minlength=len(names))
    least = max(3, 0.005 * toxic.sum())
    good = (bad >= least) & (bad >= PURITY * every)
    pair = pair[good[pair[:, 0]] & toxic[pair[:, 1]]]
    chosen = set(np.flatnonzero(good & (bad >= 0.05 * toxic.sum()) & (bad >= 20)))
    covered = np.zeros(len(toxic), dtype=bool)
    covered[pair[np.isin(pair[:, 0], list(chosen)), 1]] = True
    while True:
        gain = np.bincount(pair[~covered[pair[:, 1]], 0], minlength=len(names))
        if not len(gain) or gain.max() < least:
            return names[sorted(chosen)]
        best = int(gain.argmax())
        chosen.add(best)
        covered[pair[pair[:, 0] == best, 1]] = True


@dataclass
class Model:
    """Weights in a table of slots, each holding the one feature ``names`` tells; transitions; score weights."""

    names: np.ndarray
    weights: np.ndarray
    bias: float
    transition: np.ndarray
    score: np.ndarray

    def emission(self, features: np.ndarray) -> np.ndarray:
        slot = (features >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        return np.where(self.names[slot] == features, self.weights[slot], 0).sum(axis=1) + self.bias


def _fit_field(t: Tokens, tag: np.ndarray) -> Model:
    """Maximum likelihood with a small ridge, by Adam on whole gradients over chains cut at TRAIN_CHAIN tokens."""
    names, code, times = np.unique(t.features, return_inverse=True, return_counts=True)
    code = code.reshape(t.features.shape)
    used = (times >= 3) & (names != 0)
    place = np.full(len(names), used.sum(), dtype=np.int64)
    place[used] = np.arange(used.sum())
    code, names = place[code], names[used]
    size = len(names)
    at = np.arange(len(tag))
    head = np.zeros(len(tag) + 1, dtype=bool)
    head[t.chains] = True
    since = at - np.maximum.accumulate(np.where(head[:-1], at, 0))
    chains = np.append(np.flatnonzero(since % TRAIN_CHAIN == 0), len(tag))
    inner = np.ones(len(tag), dtype=bool)
    inner[chains[:-1]] = False
    second = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (tag[second - 1], tag[second]), 1)
    theta = np.zeros(size + 1 + 1 + 4)
    theta[size + 1] = -3.0
    one, two = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, ROUNDS + 1):
        weights, bias, transition = theta[: size + 1], theta[size + 1], theta[size + 2 :].reshape(2, 2)
        weights[size] = 0
        emission = weights[code].sum(axis=1) + bias
        odds, forward, backward = marginal_odds(emission, chains, transition)
        chance = sigmoid(odds)
        error = chance - tag
        gradient = np.zeros_like(theta)
        gradient[: size + 1] = np.bincount(code.ravel(), weights=np.repeat(error, KINDS), minlength=size + 1) + 0.01 * weights
        gradient[size + 1] = error.sum()
        a, b = forward[second - 1], backward[second] + emission[second]
        joint = np.stack([np.zeros(len(second)), b, a, a + b], axis=1) + transition.ravel()
        joint = np.exp(joint - joint.max(axis=1, keepdims=True))
        joint /= joint.sum(axis=1, keepdims=True)
        gradient[size + 2 :] = joint.sum(axis=0) - seen.ravel() + 0.01 * transition.ravel()
        one = 0.9 * one + 0.1 * gradient
        two = 0.999 * two + 0.001 * gradient**2
        theta = theta - 0.25 * (one / (1 - 0.9**step)) / (np.sqrt(two / (1 - 0.999**step)) + 1e-8)
    slots, kept = np.zeros(1 << SLOT_BITS, dtype=np.uint64), np.zeros(1 << SLOT_BITS)
    order = np.argsort(np.abs(theta[:size]))
    slot = (names[order] >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
    slots[slot], kept[slot] = names[order], theta[:size][order]
    return Model(slots, kept, float(theta[size + 1]), theta[size + 2 :].reshape(2, 2), np.zeros(3))


def sums(row: np.ndarray, odds: np.ndarray, n: int) -> np.ndarray:
    """Per document: 1, the largest log odds of a token, log(1 + expected number of toxic tokens that are likelier than not)."""
    top = np.full(n, -15.0)
    np.maximum.at(top, row, np.clip(odds, -15, 15))
    chance = sigmoid(odds)
    many = np.bincount(row, weights=np.where(chance > SPAN_CHANCE, chance, 0), minlength=n)
    return np.stack([np.ones(n), top / 15, np.log1p(many)], axis=1)


def _fit_score(x: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression with a ridge, by Newton steps."""
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = sigmoid(x @ beta)
        gradient = x.T @ (weight * (p - toxic)) + 0.1 * beta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(beta))
        beta = beta - np.linalg.solve(curve, gradient)
    return beta


def _train(batches: Iterator[pa.RecordBatch], weights: tuple[float, float]) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(list(batches), pa.schema([("text", pa.string()), ("toxic", pa.int32())]))
    order = sorted(range(len(table)), key=lambda i: (table["toxic"][i].as_py(), table["text"][i].as_py() or ""))
    table = table.take(order).combine_chunks()
    if len(table):
        toxic = table["toxic"].to_numpy() == 1
        t = tokens_of(table["text"].chunk(0))
        words = lexicon(t.features, t.row, toxic)
        tag = (np.isin(t.features, words).any(axis=1) & toxic[t.row]).astype(np.int64)
        model = _fit_field(t, tag)
        odds = marginal_odds(model.emission(t.features), t.chains, model.transition)[0]
        model.score = _fit_score(sums(t.row, odds, len(table)), toxic, np.where(toxic, weights[1], weights[0]))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])


def learn(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model | None:
    """A model from labelled documents, or None without any.

    At most TOXIC_ROWS and CLEAN_ROWS of them, by a hash of the id, are fitted in one task;
    the score's weights restore the shares of the classes among all labels given. Null
    labels are left out; of several labels of a document the largest counts.
    """
    marks = labels.select(F.col(id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("toxic"))
    marks = marks.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen, weights = None, []
    for value, bound in ((0, CLEAN_ROWS), (1, TOXIC_ROWS)):
        rows = marks.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
        chosen = rows if chosen is None else chosen.unionByName(rows)
        weights.append(max(1.0, total.get(value, 0) / bound))
    texts = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # At most TOXIC_ROWS + CLEAN_ROWS rows of two numbers.
    sample = texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic").repartition(1)
    row = sample.mapInArrow(partial(_train, weights=tuple(weights)), "model binary").first()
    return pickle.loads(bytes(row["model"])) if row else None


SPAN = pa.struct([("low", pa.int32()), ("high", pa.int32()), ("chance", pa.float64())])


def _score(batches: Iterator[pa.RecordBatch], model: Model | None, kept: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "_text", CHAIN_BYTES):
        n = batch.num_rows
        score, spans = np.zeros(n), [[] for _ in range(n)]
        if model is not None:
            t = tokens_of(batch["_text"])
            odds = marginal_odds(model.emission(t.features), t.chains, model.transition)[0]
            score = sigmoid(sums(t.row, odds, n) @ model.score)
            chance = sigmoid(odds)
            likely = np.flatnonzero(chance > SPAN_CHANCE)
            if len(likely):
                points = np.append(0, np.cumsum((t.data & 0xC0) != 0x80))
                base = points[t.offsets[t.row[likely]]]
                low, high = points[t.start[likely]] - base, points[t.end[likely]] - base
                for i, a, b, c in zip(t.row[likely], low, high, chance[likely]):
                    spans[i].append((int(a), int(b), float(c)))
        made = [pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32)), pa.array(spans, pa.list_(SPAN))]
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), *made], names=[*kept, "score", "predicted", "toxic_spans"])


def score(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1), predicted (score >= THRESHOLD) and toxic_spans.

    toxic_spans are (first code point, end, chance) of the words tagged toxic. Null and empty
    texts have no token and get the score of a text without one; without a model all scores
    are 0. Columns of ``docs`` with these names are replaced.
    """
    docs = docs.drop("score", "predicted", "toxic_spans")
    kept = docs.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    made = "score double, predicted int, toxic_spans array<struct<low:int,high:int,chance:double>>"
    rows = docs.withColumn("_text", F.col(text))
    return rows.mapInArrow(partial(_score, model=model, kept=kept), f"{kinds + ', ' if kinds else ''}{made}")


def learn_and_score(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``score`` with a model learnt from the labels that are not held out."""
    return score(docs, learn(docs, labels.where(~held_out(F.col(id))), id, text), text)
