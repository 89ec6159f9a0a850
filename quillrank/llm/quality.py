"""Quality classifier: learned vectors of hashed words and character n-grams, averaged per document, softmax output.

Features of a text are its words, pairs of neighbouring words (a word that follows itself is one feature, whatever the
word) and all runs of three and four bytes. It is trained by stochastic gradient descent in numpy on a bounded sample:
the sample's features are dealt to a few tasks, each goes through its part, and the models are averaged between
rounds. The averaged vector is linear in its features, so scoring looks up one number per feature.

Defined cases: null and empty texts have no features and get the score of the bias; documents labelled both ways are not
learned from; without any labels every score is 0.5; repeated rows are each scored; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from quillrank.llm.words import cut, mix, run_fingerprints, slices
from quillrank.workspace import Workspace

SAMPLE_PER_LABEL = 1024  # documents learned from, at most, of each label
BUCKETS = 1 << 16
DIM = 8
GRAMS = (3, 4)
SHARDS = 4
ROUNDS = 8  # models are averaged so often
UPDATES = 4096  # documents that a round goes through at least, a small sample several times
RATE = 0.5
THRESHOLD = 0.3
SLICE_BYTES = 1 << 19  # of text at once; features take some 150 times that
_REPEATED = 0  # the bucket of a word that follows itself


@dataclass(frozen=True)
class Model:
    vectors: np.ndarray = field(repr=False)  # BUCKETS x DIM
    output: np.ndarray = field(repr=False)  # DIM x 2
    bias: np.ndarray

    @staticmethod
    def start() -> Model:
        numbers = mix(np.arange(BUCKETS * DIM, dtype=np.uint64), 3) >> np.uint64(11)
        vectors = (numbers.astype(np.float64) / (1 << 53) - 0.5) / DIM
        return Model(vectors.reshape(BUCKETS, DIM).astype(np.float32), np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32))

    def pack(self) -> bytes:
        return b"".join(np.ascontiguousarray(x, np.float32).tobytes() for x in (self.vectors, self.output, self.bias))

    @staticmethod
    def unpack(data: bytes) -> Model:
        flat = np.frombuffer(data, np.float32).copy()
        a, b = BUCKETS * DIM, BUCKETS * DIM + 2 * DIM
        return Model(flat[:a].reshape(BUCKETS, DIM), flat[a:b].reshape(DIM, 2), flat[b:])

    def per_bucket(self) -> np.ndarray:
        """What each feature adds to the difference of the two outputs, before averaging."""
        return self.vectors.astype(np.float64) @ (self.output[:, 1] - self.output[:, 0]).astype(np.float64)


def _bucket(prints: np.ndarray, kind: int) -> np.ndarray:
    return (mix(prints, kind) >> np.uint64(64 - 16)).astype(np.int64)


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the features of all texts, text after text, and where each text's begin."""
    words = cut(column, lower=False)
    prints = words.fingerprints()
    text = np.repeat(np.arange(len(words.counts)), words.counts)
    kinds = [(_bucket(prints, 0), text)]
    starts, owner = words.run_starts(2)
    if len(starts):
        same = prints[starts] == prints[starts + 1]
        kinds.append((np.where(same, _REPEATED, _bucket(run_fingerprints(prints, starts, 2), 1)), owner))
    sizes = np.diff(words.bounds)
    data = words.data.astype(np.uint64)
    for n in GRAMS:
        count = np.maximum(sizes - n + 1, 0)
        owner = np.repeat(np.arange(len(sizes)), count)
        if len(owner):
            at = np.arange(len(owner)) + np.repeat(words.bounds[:-1] - (np.cumsum(count) - count), count)
            gram = sum((data[at + i] << np.uint64(8 * i) for i in range(1, n)), data[at])
            kinds.append((_bucket(gram, n), owner))
    buckets, owners = (np.concatenate(x) for x in zip(*kinds))
    order = np.argsort(owners, kind="stable")
    return buckets[order], np.searchsorted(owners[order], np.arange(len(sizes) + 1))


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def training_ids(labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> DataFrame:
    """``(doc_id, quality)``: at most ``per_label`` documents of each label that are not held out."""
    known = labels.where(F.col("quality").isin(0, 1) & (remainder(F.col("doc_id")) != 0))
    clear = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).where("quality = other")
    chosen = [
        clear.where(F.col("quality") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label) for label in (0, 1)
    ]
    return chosen[0].union(chosen[1]).select("doc_id", F.col("quality").cast("int").alias("quality"))


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, size=SLICE_BYTES):
        buckets, first = features(batch.column("text"))
        found = [np.unique(buckets[a:b], return_counts=True) for a, b in zip(first[:-1], first[1:])]
        shares = [(count / max(1, count.sum())).astype(np.float32) for _, count in found]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").cast(pa.string()),
                batch.column("quality"),
                pa.array([f.astype(np.int32) for f, _ in found], pa.list_(pa.int32())),
                pa.array(shares, pa.list_(pa.float32())),
            ],
            names=["doc_id", "quality", "bucket", "share"],
        )


def _descend(model: Model, rows: pd.DataFrame, rate: float, weight: dict[int, float]) -> Model:
    vectors, output, bias = model.vectors, model.output, model.bias
    for quality, bucket, share in zip(rows["quality"], rows["bucket"], rows["share"]):
        if not len(bucket):
            continue
        hidden = share @ vectors[bucket]
        logits = hidden @ output + bias
        wrong = np.exp(logits - logits.max())
        wrong /= wrong.sum()
        wrong[int(quality)] -= 1
        wrong *= weight[int(quality)]
        back = output @ wrong
        output -= rate * np.outer(hidden, wrong)
        bias -= rate * 0.1 * wrong
        # The share of a feature is small, so vectors get a higher rate; each is in a text once.
        vectors[bucket] -= (10 * rate * share)[:, None] * back[None, :]
    return model


def averaged(parts: pd.DataFrame) -> pd.DataFrame:
    """The mean of a round's models, each by the rows that it was learned from: the driver is sent this one only."""
    parts = parts.sort_values("shard")
    weights = parts["rows"].to_numpy(np.float64)
    stack = np.stack([np.frombuffer(model, np.float32) for model in parts["model"]])
    return pd.DataFrame({"model": [(weights / weights.sum() @ stack).astype(np.float32).tobytes()]})


def train(documents: DataFrame, labels: DataFrame, workspace: Workspace, per_label: int = SAMPLE_PER_LABEL) -> Model:
    """Learn ``quality`` of ``labels`` from the texts of ``documents``, at most ``2 * per_label`` of them."""
    ids = F.broadcast(training_ids(labels, per_label))  # that many rows
    texts = documents.select("doc_id", "text").join(ids, "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    schema = "doc_id string, quality int, bucket array<int>, share array<float>"
    sample = workspace.save(texts.mapInArrow(_sample_features, schema), "sample")
    dealt = sample.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(SHARDS)).cast("int"))

    counts = {row["quality"]: row["n"] for row in sample.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    weight = {label: total / (len(counts) * n) for label, n in counts.items()}  # both labels count alike
    passes = -(-UPDATES // max(1, total))

    model = Model.start()
    for at in range(ROUNDS):
        packed, rate = model.pack(), RATE * (1 - at / ROUNDS)

        def fit(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("doc_id", kind="stable")
            model = Model.unpack(packed)
            for turn in range(at * passes, (at + 1) * passes):
                order = np.argsort(mix(np.arange(len(rows), dtype=np.uint64), turn))
                model = _descend(model, rows.iloc[order], rate, weight)
            return pd.DataFrame({"shard": rows["shard"].iloc[:1], "rows": [len(rows)], "model": [model.pack()]})

        parts = dealt.groupBy("shard").applyInPandas(fit, "shard int, rows long, model binary")
        found = parts.groupBy().applyInPandas(averaged, "model binary").collect()
        if not found:
            break
        model = Model.unpack(found[0].model)
    return model


def scores(column: pa.Array, weights: np.ndarray, bias: float) -> np.ndarray:
    """Probability of label 1 per text."""
    buckets, first = features(column)
    below = np.concatenate([[0.0], np.cumsum(weights[buckets])])
    mean = (below[first[1:]] - below[first[:-1]]) / np.maximum(np.diff(first), 1)
    return 1 / (1 + np.exp(-(mean + bias)))


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)`` for every row, from its whole text."""
    frame = documents.select("doc_id", "text")
    schema = T.StructType([frame.schema["doc_id"], T.StructField("score", T.DoubleType())])
    weights, bias = model.per_bucket(), float(model.bias[1] - model.bias[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=SLICE_BYTES):
            found = pa.array(scores(batch.column("text"), weights, bias))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), found], names=["doc_id", "score"])

    return frame.mapInArrow(run, schema)


def accepted(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents`` that score at least ``threshold``, with all their columns."""
    weights, bias = model.per_bucket(), float(model.bias[1] - model.bias[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=SLICE_BYTES):
            yield batch.filter(pa.array(scores(batch.column("text"), weights, bias) >= threshold))

    return documents.mapInArrow(run, documents.schema)
