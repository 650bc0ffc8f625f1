"""Quality classifier: logistic regression on hashed word n-grams, trained with
follow-the-regularised-leader updates and scored as sparse dot products.

A text's n-grams are its words and pairs of successive words, once as they stand and once as
shapes (runs of one kind of character become one, so ``WORD!!`` and ``TEXT!!`` agree), and a
mark on every word that equals the one before it. Each is hashed to one of ``DIMENSIONS``
weights. Its value is ``SCALE`` / number of n-grams of the text, so a score does not depend on
a text's length and is one gather and one sum.

Training reads at most ``MOST_LABELS`` labelled rows, those least by a hash of their id: a fixed
bound that does not depend on the input. They are dealt to ``SHARDS`` tasks; each runs
FTRL-proximal over its rows from the shared state, and the states are averaged after every
round (iterative parameter mixing). Only states, of fixed size, pass through the driver.

Defined results. Rows whose crc32(doc_id as text) mod 4 is 2 are held out, rows without id are
not. Null, empty and blank texts have no n-grams and get the score of the bias alone. An id with
several labels counts as their majority, 1 on a tie. Without any usable label every score is
0.5. Nothing but the text enters a score.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from debtlens.llm import words as W
from debtlens.llm.scratch import stored
from debtlens.llm.ship import ship

LOG_DIMENSIONS = 18
DIMENSIONS = 1 << LOG_DIMENSIONS
SCALE = 30.0
MOST_LABELS = 20_000
SHARDS, ROUNDS = 8, 3
ALPHA, BETA, L1, L2 = 0.5, 0.1, 0.01, 0.1
THRESHOLD = 0.7

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = 65, 97, 48, 120


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Weight indices of all n-grams, text after text, and where each text's start."""
    data, offsets = W.buffers(texts)
    starts, ends, first = W.find(data, offsets)
    kinds = _CLASS[data]
    new = np.ones(len(kinds), bool)
    new[1:] = kinds[1:] != kinds[:-1]
    new[starts] = True
    kept = np.concatenate([[0], np.cumsum(new)])
    plain = W.hashes(data, starts, ends)
    shape = W.hashes(kinds[new], kept[starts], kept[ends])
    n = len(starts)
    out = np.zeros((n, 5), np.uint64)
    out[:, 0] = plain + np.uint64(1)
    out[:, 1] = shape + np.uint64(2)
    # Pairs belong to their second word; the first word of a text pairs with the text's edge.
    edge = np.zeros(n, bool)
    edge[first[:-1][first[:-1] < first[1:]]] = True
    for column, one, tag in ((2, plain, 3), (3, shape, 4)):
        before = np.concatenate([one[:1], one[:-1]])
        before = np.where(edge, np.uint64(0), before)
        out[:, column] = W.mix(before * np.uint64(0xD6E8FEB86659FD93) + one) + np.uint64(tag)
        if column == 2:
            out[:, 4] = np.where(before == one, np.uint64(5), np.uint64(6))
    index = (W.mix(out.ravel()) >> np.uint64(64 - LOG_DIMENSIONS)).astype(np.int32)
    return index, first * 5


def _examples(batches):
    """Labelled texts as (shard, order, label, index, value)."""
    for batch in batches:
        texts = batch.column("text")
        for a, b in W.slices(texts):
            index, first = features(texts.slice(a, b - a))
            rows = [np.unique(index[i:j], return_counts=True) for i, j in zip(first[:-1], first[1:])]
            total = [max(1, j - i) for i, j in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("shard").slice(a, b - a),
                    batch.column("place").slice(a, b - a),
                    batch.column("label").slice(a, b - a),
                    pa.array([r[0] for r in rows], pa.list_(pa.int32())),
                    pa.array([(r[1] * (SCALE / n)).astype(np.float32) for r, n in zip(rows, total)], pa.list_(pa.float32())),
                ],
                names=["shard", "place", "label", "index", "value"],
            )
    W.trim()


@dataclass
class State:
    """FTRL-proximal state; the last coordinate is the bias, whose value is always 1."""

    z: np.ndarray
    n: np.ndarray

    @classmethod
    def new(cls) -> State:
        return cls(np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1))

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, index: np.ndarray, value: np.ndarray, label: int) -> None:
        index, value = np.append(index, DIMENSIONS), np.append(value, 1.0).astype(np.float64)
        weights = self.weights(index)
        slope = (_sigmoid(float(weights @ value)) - label) * value
        squares = self.n[index] + slope * slope
        self.z[index] += slope - (np.sqrt(squares) - np.sqrt(self.n[index])) / ALPHA * weights
        self.n[index] = squares


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _shard(state: State) -> Callable[[pa.Table], pa.Table]:
    def learn(table: pa.Table) -> pa.Table:
        own = State(state.z.copy(), state.n.copy())
        table = table.sort_by("place")
        index, value = table["index"].combine_chunks(), table["value"].combine_chunks()
        for i, label in enumerate(table["label"].to_pylist()):
            own.learn(index[i].values.to_numpy(), value[i].values.to_numpy(), label)
        return pa.table({"z": [own.z.astype(np.float32).tobytes()], "n": [own.n.astype(np.float32).tobytes()]})

    return learn


def held_out(doc_id) -> F.Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELS, rounds: int = ROUNDS) -> np.ndarray | None:
    """The weights, bias last; None if no labelled text may be learned from."""
    spark = docs.sparkSession
    ship(spark)
    usable = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("q"))
        .where("doc_id IS NOT NULL AND q IS NOT NULL")
        .where(~held_out("doc_id"))
        .groupBy("doc_id")
        .agg((F.avg("q") >= 0.5).cast("int").alias("label"))
        .withColumn("place", F.xxhash64("doc_id"))
        .orderBy("place", "doc_id")
        .limit(most)
    )
    # At most ``most`` rows of 20 bytes.
    sample = F.broadcast(usable.withColumn("shard", F.pmod("place", F.lit(SHARDS)).cast("int")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    examples = stored(
        texts.join(sample, "doc_id")
        .select("shard", "place", "label", "text")
        .mapInArrow(_examples, "shard int, place long, label int, index array<int>, value array<float>"),
        "quality_examples",
    )
    state, seen = State.new(), False
    for _ in range(rounds):
        shards = examples.groupBy("shard").applyInArrow(_shard(state), "z binary, n binary").collect()
        if shards:
            seen = True
            state = State(*(np.mean([np.frombuffer(s[k], np.float32) for s in shards], axis=0, dtype=np.float64) for k in (0, 1)))
    return state.weights() if seen else None


def scorer(spark, weights: np.ndarray | None):
    """An Arrow function from binary texts to scores."""
    held = spark.sparkContext.broadcast((weights if weights is not None else np.zeros(DIMENSIONS + 1)).astype(np.float32))

    def score(texts: pa.Array) -> pa.Array:
        own = held.value
        bias, out = float(own[-1]), []
        for a, b in W.slices(texts):
            index, first = features(texts.slice(a, b - a))
            sums = np.concatenate([[0.0], np.cumsum(own[index], dtype=np.float64)])
            n = np.diff(first)
            out.append(_sigmoid(bias + (sums[first[1:]] - sums[first[:-1]]) * (SCALE / np.maximum(n, 1))))
        W.trim()
        return pa.array(np.concatenate(out) if out else np.empty(0), pa.float64())

    return F.arrow_udf(score, "double")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    score = scorer(docs.sparkSession, train(docs, labels))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out("doc_id").alias("held_out"),
        score(F.col("text").cast("binary")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts; all of them if it could learn nothing."""
    weights = train(docs, labels)
    if weights is None:
        return docs
    score = scorer(docs.sparkSession, weights)
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    return (
        docs.select(whole).withColumn("_score", score(F.col("_row.text").cast("binary")))
        .where(F.col("_score") >= THRESHOLD)
        .select("_row.*")
    )
