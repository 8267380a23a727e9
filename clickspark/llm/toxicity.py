"""Toxicity scores by logistic regression on hashed n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickspark.llm.sampling import bounded_sample, remainder
from clickspark.llm.storage import Sent
from clickspark.llm.words import BARE, blocks, hash_spans, split_words

BITS = 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Model:
    """``weights`` of the hashed features that are not zero, by ``index``."""

    index: np.ndarray
    weights: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        every = np.zeros(1 << BITS, np.float32)
        every[self.index] = self.weights
        return every


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of whole texts: hashes of words, of pairs of neighbours and of
    pairs with a word between (skip-grams), with the index of each one's text.

    Words are lower-cased (A-Z) runs of bytes other than white space and ASCII
    punctuation.
    """
    words = split_words(texts, BARE)
    hashes = hash_spans(words.data, words.starts, words.ends)
    owner = np.repeat(np.arange(len(texts)), np.diff(words.first))
    found, owners = [hashes], [owner]
    with np.errstate(over="ignore"):
        for gap in (1, 2):
            together = owner[gap:] == owner[:-gap]
            pair = (hashes[:-gap] * _MIX + np.uint64(gap)) ^ (hashes[gap:] >> np.uint64(1))
            found.append((pair * _MIX)[together])
            owners.append(owner[gap:][together])
    slots = np.concatenate(found) >> np.uint64(64 - BITS)
    return slots.astype(np.int64), np.concatenate(owners)


def ftrl(
    rows: list[np.ndarray],
    labels: list[int],
    alpha: float,
    beta: float,
    l1: float,
    l2: float,
    epochs: int,
) -> Model:
    """FTRL-proximal: every coordinate has its own rate, and weights whose
    gradients do not add up to more than ``l1`` are exactly zero. Each row is
    its different features, as a vector of length 1."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(at: np.ndarray) -> np.ndarray:
        own = z[at]
        free = np.where(at == 1 << BITS, 0, l1)
        step = np.sign(own) * free - own
        return np.where(np.abs(own) <= free, 0.0, step / ((beta + np.sqrt(n[at])) / alpha + l2))

    for _ in range(epochs):
        for row, label in zip(rows, labels):
            at = np.append(row, 1 << BITS)
            value = np.full(len(at), 1 / np.sqrt(max(1, len(row))))
            value[-1] = 1
            w = weights(at)
            gradient = (1 / (1 + np.exp(-np.clip(w @ value, -35, 35))) - label) * value
            z[at] += gradient - (np.sqrt(n[at] + gradient**2) - np.sqrt(n[at])) / alpha * w
            n[at] += gradient**2
    every = weights(np.arange((1 << BITS) + 1))
    index = np.flatnonzero(every[:-1])
    return Model(index, every[index].astype(np.float32), float(every[-1]))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    label: str = "toxic",
    doc_id: str = "doc_id",
    sample_rows: int = 12_288,
    most_chars: int = 20_000,
    alpha: float = 100.0,
    beta: float = 1.0,
    l1: float = 0.5,
    l2: float = 0.0,
    epochs: int = 3,
) -> Model:
    """A model of ``label`` (0 or 1), which ``labels`` has by document id.

    It is fitted to ``sample_rows`` documents at most, as many of each label,
    with texts of up to ``most_chars`` characters. Hashed features, not texts,
    go to the one task that fits them. Labels that are null or that differ for
    one id count as the larger; ids without a document are left out.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("doc_id"))
        .agg(F.max(label).cast("int").alias("label"))
    )
    chosen = bounded_sample(known, "label", "doc_id", sample_rows // 2, 2)
    texts = docs.where(F.length(text) <= most_chars).select(
        F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    # The sample has at most sample_rows ids, so texts need no shuffle to meet it.
    rows = texts.join(F.broadcast(chosen), "doc_id").select("order", "doc_id", "label", "text")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, part in blocks(batch.column(3)):
                slots, owner = features(part)
                keys = np.unique(owner << BITS | slots)
                cuts = np.searchsorted(keys >> BITS, np.arange(len(part) + 1))
                values = pa.array((keys & ((1 << BITS) - 1)).astype(np.int32))
                lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), values)
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(at, to - at) for c in batch.columns[:3]), lists],
                    ["order", "doc_id", "label", "slots"],
                )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, wanted = [], []
        for batch in batches:
            found += [x.values.to_numpy() for x in batch.column(3)]
            wanted += batch.column(2).to_pylist()
        model = ftrl(found, wanted, alpha, beta, l1, l2, epochs)
        index = np.append(model.index, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(index), pa.array(np.append(model.weights.astype(float), model.bias))],
            ["slot", "weight"],
        )

    prepared = rows.mapInArrow(hashed, "order long, doc_id long, label int, slots array<int>")
    one = prepared.repartition(1).sortWithinPartitions("order", "doc_id")
    learnt = one.mapInArrow(learn, "slot long, weight double").toPandas().sort_values("slot")
    slots, weights = learnt["slot"].to_numpy(), learnt["weight"].to_numpy()
    own = slots >= 0
    bias = float(weights[~own][0]) if (~own).any() else 0.0
    return Model(slots[own], weights[own].astype(np.float32), bias)


def scores(model: Model, dense: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """The probability of label 1; without words, what the bias says."""
    slots, owner = features(texts)
    sizes = np.zeros(len(texts))
    totals = np.zeros(len(texts))
    if len(slots):
        keys = np.unique(owner << BITS | slots)
        np.add.at(sizes, keys >> BITS, 1)
        hit = keys[dense[keys & ((1 << BITS) - 1)] != 0]
        np.add.at(totals, hit >> BITS, dense[hit & ((1 << BITS) - 1)].astype(float))
    return 1 / (1 + np.exp(-np.clip(model.bias + totals / np.sqrt(np.maximum(1, sizes)), -35, 35)))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 from a half) of whole texts.

    Null texts count as empty; repeated rows each get their score. Columns of
    these names are replaced. The model is broadcast: it has at most 2**20
    weights (12 MB), and few after L1.
    """
    sent = Sent(docs.sparkSession, model)
    others = [c for c in docs.columns if c not in ("score", "predicted")]
    at = others.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = sent.value.dense()
        for batch in batches:
            found = [scores(sent.value, dense, part) for _, _, part in blocks(batch.column(at))]
            values = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(values), pa.array((values >= 0.5).astype(np.int32))],
                [*others, "score", "predicted"],
            )

    kept = docs.select(*(F.col(f"`{c}`") for c in others))
    schema = T.StructType([*kept.schema.fields]).add("score", "double").add("predicted", T.IntegerType())
    return kept.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id"):
    """Rows that a model is tested on, not fitted to."""
    return F.coalesce(remainder(doc_id, 5) == 0, F.lit(False))
