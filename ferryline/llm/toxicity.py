"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes ratios.

A text's features are the presence of its hashed character n-grams (lower case, three
to five code points). Training: document frequencies per class give each n-gram a
log-count ratio r; the ``features`` n-grams with the strongest ratios are kept, a
logistic regression is fitted on the presence vectors scaled by r, and weight times
ratio is the score's coefficient. Fitting takes at most ``per_class`` labelled rows of
each class (those with the smallest hashes of their ids), weighted back to the class
counts of all labels; this is the only bound, and scoring reads every whole text.

Scoring is one pass without a shuffle; each task holds one table of coefficients
whose size is a parameter.

Results for odd input: NULL and empty texts score the intercept; without labels of
both classes every text scores the share of toxic labels (0 without any); several labels of an
id count once, toxic if any is; rows whose label is NULL are not learnt from; repeated rows are
scored each; an empty table gives no rows. Columns named like an added one are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import ElementwiseProduct
from pyspark.ml.linalg import SparseVector, Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferryline.llm.rows import col
from ferryline.shared import materialize

SIZES = (3, 4, 5)
BUCKET_BITS = 20
FEATURES = 1 << 15
PER_CLASS = 4000
#: Rows in which a kept n-gram must occur.
LEAST_ROWS = 4
ITERATIONS, REGULARISATION = 40, 1e-3
#: Code points hashed at once; longer texts go piece by piece, with overlap.
PIECE = 1 << 20
ADDED = ("score", "predicted")


def ngram_buckets(text: str | None) -> Iterator[np.ndarray]:
    """The buckets of all n-grams of a text, with repeats, piece by piece."""
    body = f" {text.lower()} " if text else ""
    shift, mix = np.uint64(64 - BUCKET_BITS), np.uint64(0x9E3779B97F4A7C15)
    longest = max(SIZES)
    for at in range(0, max(len(body) - 1, 0), PIECE):
        piece = body[at:at + PIECE + longest - 1]
        points = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        value = points
        for n in range(2, longest + 1):
            value = value[:len(points) - n + 1] * np.uint64(1000003) + points[n - 1:]
            if n in SIZES and len(value):
                yield (((value + np.uint64(n)) * mix) >> shift).astype(np.int64)


@dataclass
class Model:
    """``place`` maps a bucket to its coefficient, or to none with -1."""

    place: np.ndarray
    weights: np.ndarray
    intercept: float

    def score(self, texts: pd.Series) -> np.ndarray:
        seen = np.zeros(len(self.weights), bool)
        out = np.empty(len(texts))
        for i, text in enumerate(texts):
            marked = []
            for buckets in ngram_buckets(text if isinstance(text, str) else None):
                places = self.place[buckets]
                places = places[places >= 0]
                seen[places] = True
                marked.append(places)
            z = self.intercept + float(self.weights[seen].sum())
            for places in marked:
                seen[places] = False
            out[i] = 1 / (1 + math.exp(-max(min(z, 500), -500)))
        return out


def constant(share: float) -> Model:
    share = min(max(share, 1e-9), 1 - 1e-9)
    return Model(np.full(1 << BUCKET_BITS, -1, np.int32), np.zeros(0), math.log(share / (1 - share)))


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id",
          label: str = "toxic", learn: Column | None = None, per_class: int = PER_CLASS,
          features: int = FEATURES) -> Model:
    """Fit on at most ``per_class`` rows of each class whose ids satisfy ``learn``."""
    marked = labels.where(col(doc_id).isNotNull() & col(label).isNotNull()
                          & (learn if learn is not None else F.lit(True)))
    marked = marked.groupBy(col(doc_id).alias("id")).agg(
        F.max((col(label) > 0).cast("int")).alias("label"))
    totals = {r[0]: r[1] for r in marked.groupBy("label").count().collect()}
    if len(totals) < 2:
        return constant(totals.get(1, 0) / max(sum(totals.values()), 1))
    order = [F.xxhash64("id"), F.col("id")]
    parts = [marked.where(F.col("label") == c).orderBy(*order).limit(per_class) for c in (0, 1)]
    chosen = F.broadcast(parts[0].unionAll(parts[1]))  # at most 2 * per_class ids

    @F.pandas_udf("array<int>")
    def buckets_of(texts: pd.Series) -> pd.Series:
        def distinct(t):
            found = [np.unique(b) for b in ngram_buckets(t if isinstance(t, str) else None)]
            return np.unique(np.concatenate(found)).astype(np.int32) if found else np.zeros(0, np.int32)
        return texts.map(distinct)

    rows = materialize(
        docs.select(col(doc_id).alias("id"), col(text).alias("body")).join(chosen, "id")
        .select("id", "label", buckets_of("body").alias("buckets")), "toxic-train")
    sampled = {r[0]: r[1] for r in rows.groupBy("label").count().collect()}
    if len(sampled) < 2:
        return constant(sampled.get(1, 0) / max(sum(sampled.values()), 1))

    count = rows.select("label", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(
        F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("n"))
    sums = count.agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"),
                     F.count(F.lit(1)).alias("k")).first()
    if not sums["n"]:
        return constant(sampled[1] / (sampled[0] + sampled[1]))
    all_toxic, all_clean = sums["toxic"] + sums["k"], sums["n"] - sums["toxic"] + sums["k"]
    ratio = (F.log((F.col("toxic") + 1) / F.lit(float(all_toxic)))
             - F.log((F.col("n") - F.col("toxic") + 1) / F.lit(float(all_clean))))
    best = count.where(F.col("n") >= min(LEAST_ROWS, min(sampled.values()))).select(
        "bucket", "n", ratio.alias("r")).orderBy(
        F.desc(F.abs("r") * F.sqrt("n")), "bucket").limit(features).toPandas()  # bounded by `features`
    if not len(best):
        return constant(sampled[1] / (sampled[0] + sampled[1]))
    place = np.full(1 << BUCKET_BITS, -1, np.int32)
    place[best["bucket"].to_numpy()] = np.arange(len(best))
    ratios = best["r"].to_numpy()
    size = len(best)

    @F.udf(VectorUDT())
    def vector(buckets):
        at = np.sort(place[np.array(buckets, np.int64)]) if len(buckets) else np.zeros(0, np.int32)
        at = at[at >= 0]
        return SparseVector(size, at.tolist(), [1.0] * len(at))

    weight = F.when(F.col("label") == 1, totals[1] / sampled[1]).otherwise(totals[0] / sampled[0])
    tasks = max(1, min(8, (sampled[0] + sampled[1]) // 500))
    data = materialize(rows.coalesce(tasks).select(
        F.col("label").cast("double").alias("label"), weight.alias("weight"),
        vector("buckets").alias("present")), "toxic-vectors")
    scaled = ElementwiseProduct(scalingVec=Vectors.dense(ratios), inputCol="present",
                                outputCol="features").transform(data)
    fitted = LogisticRegression(
        maxIter=ITERATIONS, regParam=REGULARISATION, standardization=False, weightCol="weight",
        tol=1e-5).fit(scaled.select("label", "weight", "features"))
    return Model(place, fitted.coefficients.toArray() * ratios, float(fitted.intercept))


def score_toxicity(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on)."""
    shared = df.sparkSession.sparkContext.broadcast((model.place, model.weights, model.intercept))

    @F.pandas_udf("double")
    def scores(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        local = Model(*shared.value)
        for batch in texts:
            yield pd.Series(local.score(batch))

    kept = [col(c) for c in df.columns if c.lower() not in ADDED]
    return df.select(*kept, scores(col(text)).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))
