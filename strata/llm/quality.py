"""Quality classifier by importance resampling.

Two generative models over hashed n-grams, document frequencies of the target
(good and not toxic labelled documents) and of the raw text (all documents),
give each n-gram a log ratio.  Only n-grams that the target lacks beyond chance
count, by as many standard deviations of ``SIGMAS`` as serves held-out labels best: a document loses weight by what the
target never has, and gains none by being ordinary or long.  Its log weight is
the sum over its distinct n-grams.

Sampling: keys ``SHARPNESS * log weight + Gumbel noise``, the top k kept; k is
the number of documents over a cut that best separates labelled documents left
out of the fit.  Noise is a hash of id and text, so it is the same in every run.

Bounds: at most ``FIT_ROWS`` labelled documents of each kind are looked at, those
with the smallest id hashes, ``HOLD`` percent of them for the cut; the models
have ``ngrams.BUCKETS`` buckets.  Raw counts, weights and the selection cover all
documents.

Inputs: null and empty texts have no n-grams and weigh 1.  Null labels and
labels without a document are ignored; a document counts as good if all its
labels say so.  Without labels nothing is rejected.  Rows equal in id and text
share their fate, so ties may keep a few rows more than k.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage
from .ngrams import BUCKETS, HashedNgrams
from .select import kth_largest

FIT_ROWS = 20_000
HOLD = 30
SIGMAS = (2.0, 2.5, 3.0, 4.0)
LOST = 2.0  # a lost good document costs this many kept bad ones (as shares)
PRIOR = 1.0
SHARPNESS = 4.0
SEED = 811


@dataclass
class Model:
    buckets: np.ndarray  # ascending
    ratios: np.ndarray
    cut: float = float("-inf")

    def weigh(self, found: np.ndarray) -> float:
        if not len(self.buckets) or not len(found):
            return 0.0
        at = np.minimum(np.searchsorted(self.buckets, found), len(self.buckets) - 1)
        return float(self.ratios[at[self.buckets[at] == found]].sum())


def labelled(labels: DataFrame, id_col: str = "doc_id", quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    """``doc_id, good`` per labelled document."""
    full = labels.where(F.col(id_col).isNotNull() & F.col(quality).isNotNull() & F.col(toxic).isNotNull())
    return full.groupBy(F.col(id_col).alias("doc_id")).agg(((F.min(quality) == 1) & (F.max(toxic) == 0)).alias("good"))


def _sample(labels: DataFrame, rows: int) -> pd.DataFrame:
    by_hash = F.xxhash64("doc_id", F.lit(SEED))
    parts = [labels.where(F.col("good") == g).select("doc_id", "good", by_hash.alias("h")).orderBy("h", "doc_id").limit(rows) for g in (True, False)]
    return parts[0].unionByName(parts[1]).toPandas()


def _counts(docs: DataFrame, target: set[int]) -> DataFrame:
    """``bucket, raw, target`` document frequencies; bucket -1 counts documents."""
    ids = docs.sparkSession.sparkContext.broadcast(target)

    def count(batches):
        grams, inside = HashedNgrams(), ids.value
        raw, good = np.zeros(BUCKETS + 1, np.int64), np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = np.append(grams(text.as_py()), BUCKETS)
                raw[found] += 1
                if doc_id in inside:
                    good[found] += 1
        full = np.flatnonzero(raw)
        for i in range(0, len(full), 1 << 16):
            at = full[i : i + (1 << 16)]
            name = np.where(at == BUCKETS, -1, at).astype(np.int32)
            yield pa.RecordBatch.from_pydict({"bucket": name, "raw": raw[at], "target": good[at]})

    found = docs.mapInArrow(count, "bucket int, raw bigint, target bigint")
    return found.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_weights(model: Model, spark) -> callable:
    """A column function: log weight of a text."""
    held = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def weigh(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        grams = HashedNgrams()  # goes with the task: a worker serves the next stages too
        for texts in batches:
            yield pd.Series([held.value.weigh(grams(t)) for t in texts], dtype="float64")

    return weigh


def best_cut(good: np.ndarray, bad: np.ndarray) -> tuple[float, float]:
    """The cut between two weights with the least cost, and that cost."""
    if not len(bad):
        return float("-inf"), 0.0
    values = np.unique(np.concatenate([good, bad, [0.0]]))
    cuts = np.concatenate([[values[0] - 1], (values[:-1] + values[1:]) / 2])
    lost = np.searchsorted(np.sort(good), cuts) / max(len(good), 1)
    kept = 1 - np.searchsorted(np.sort(bad), cuts) / len(bad)
    cost = LOST * lost + kept
    return float(cuts[np.argmin(cost)]), float(cost.min())


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = FIT_ROWS) -> Model:
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    sample = _sample(labelled(labels), rows)
    held = sample[(sample.h % 100) < HOLD]
    target = {int(i) for i in sample[(sample.h % 100 >= HOLD) & sample.good].doc_id}
    counts = stage(_counts(base, target), "ngram-counts")
    total = counts.where("bucket = -1").first()
    if total is None or not total.target:
        return Model(np.zeros(0, np.int64), np.zeros(0))
    expected = F.col("raw") * F.lit(total.target / total.raw)
    z = (F.col("target") - F.col("e")) / F.sqrt(F.col("e") + 1)
    rare = counts.where("bucket >= 0").withColumn("e", expected).withColumn("z", z).where(F.col("z") <= -min(SIGMAS))
    ratio = F.log((F.col("target") + PRIOR) / (F.col("e") + PRIOR)).alias("ratio")
    found = rare.select("bucket", "z", ratio).toPandas().sort_values("bucket")  # at most BUCKETS rows
    models = []
    for sigmas in SIGMAS:
        clear = found[found.z <= -sigmas]
        models.append(Model(clear.bucket.to_numpy(np.int64), clear.ratio.to_numpy(np.float64)))
    known = spark.createDataFrame([(int(i), bool(g)) for i, g in zip(held.doc_id, held.good, strict=True)], "doc_id bigint, good boolean")
    tried = spark.sparkContext.broadcast(models)

    def weigh(batches):
        grams = HashedNgrams()
        for batch in batches:
            weights = [[m.weigh(g) for m in tried.value] for g in (grams(t.as_py()) for t in batch.column(1))]
            yield pa.RecordBatch.from_pydict({"good": batch.column(0), "w": pa.array(weights, pa.list_(pa.float64()))})

    # At most HOLD percent of the sampled labels: small enough to broadcast, by FIT_ROWS.
    seen = base.join(F.broadcast(known), "doc_id").select("good", "text").mapInArrow(weigh, "good boolean, w array<double>").toPandas()
    best = None
    for i, model in enumerate(models):
        w = np.array([x[i] for x in seen.w])
        model.cut, cost = best_cut(w[seen.good.to_numpy(bool)], w[~seen.good.to_numpy(bool)])
        if best is None or cost < best[0]:
            best = (cost, model)
    return best[1]


def sampling_key(log_weight: Column, id_col: Column, text: Column) -> Column:
    """Whole-numbered Gumbel key: millionths, then hash bits against ties."""
    h = F.xxhash64(id_col, F.xxhash64(text), F.lit(SEED))
    u = (F.shiftrightunsigned(h, 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    key = F.greatest(log_weight * SHARPNESS, F.lit(-1e6)) - F.log(-F.log(u))
    return F.round(key * 1e6).cast("bigint") * (1 << 18) + h.bitwiseAND((1 << 18) - 1)


@dataclass
class Resampler:
    """What sampling needs to decide on a row: the model and the k-th largest key."""

    model: Model
    kth: int | None
    scores: DataFrame  # staged: doc_id, log_weight, key


def resampler(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = FIT_ROWS) -> Resampler:
    model = fit(docs, labels, id_col, text_col, rows)
    weigh = log_weights(model, docs.sparkSession)
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("log_weight", weigh("text"))
    scores = stage(
        base.select("doc_id", "log_weight", sampling_key(F.col("log_weight"), F.col("doc_id"), F.col("text")).alias("key")), "quality-scores"
    )
    k = scores.where(F.col("log_weight") >= F.lit(model.cut)).count()
    kth = kth_largest(scores, "key", k) if k else None
    return Resampler(model, kth, scores)


def decide(r: Resampler) -> DataFrame:
    """``doc_id, log_weight, key, kept`` per document."""
    kept = F.col("key") >= r.kth if r.kth is not None else F.lit(False)
    return r.scores.select("doc_id", "log_weight", "key", kept.alias("kept"))


def kept_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = FIT_ROWS) -> DataFrame:
    """The sampled documents, columns as they came; decided row by row, without a join."""
    r = resampler(docs, labels, id_col, text_col, rows)
    if r.kth is None:
        return docs.limit(0)
    weigh = log_weights(r.model, docs.sparkSession)
    key = sampling_key(weigh(F.col(f"`{text_col}`")), F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    return docs.where(key >= r.kth)
