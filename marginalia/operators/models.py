"""Closed-form models over aggregated moments."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Fit = tuple[np.ndarray, np.ndarray, np.ndarray]


def fit_ridge(rows: DataFrame, target: str, features: list[str], penalty: float = 1.0, pool: str | None = None) -> Fit:
    """Means, scales and weights (the intercept first) of ridge regression on
    standardised features; a row weighs 1 / the size of its ``pool``.

    Two aggregations of moments; only those leave the cluster.  The intercept
    is not penalised; a constant feature keeps its scale of 1."""
    names = [f"x{i}" for i in range(len(features))]
    weight = F.lit(1.0)
    base = rows.select(F.col(target).cast("double").alias("y"), *[F.col(c).cast("double").alias(n) for c, n in zip(features, names, strict=True)], *([pool] if pool else []))
    if pool:
        sizes = base.groupBy(F.col(pool).alias("_pool")).agg(F.count("*").alias("_size"))
        base = base.join(sizes, F.col(pool).eqNullSafe(F.col("_pool")))
        weight = F.lit(1.0) / F.col("_size")
    base = base.withColumn("_w", weight)
    first = base.agg(*[f(F.col(n)).alias(f"{n}_{k}") for n in names for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    if first[0] is None:
        return np.zeros(len(names)), np.ones(len(names)), np.zeros(len(names) + 1)
    mean, scale = np.array([first[f"{n}_m"] for n in names]), np.array([first[f"{n}_s"] for n in names])
    scale[scale < 1e-8] = 1.0
    k = len(names) + 1

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = np.column_stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names]).reshape(len(batch), -1)
            y, w = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("y", "_w"))
            x = np.column_stack([np.ones(len(batch)), (cut - mean) / scale])
            flat = np.r_[((x * w[:, None]).T @ x).ravel(), (x * w[:, None]).T @ y]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], ["i", "v"])

    # k * (k + 1) sums a batch, added up before the shuffle
    sums = base.select("y", "_w", *names).na.drop().mapInArrow(moments, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    flat = np.zeros(k * k + k)
    flat[[r["i"] for r in sums]] = [r["v"] for r in sums]
    gram, right = flat[: k * k].reshape(k, k), flat[k * k :]
    return mean, scale, np.linalg.solve(gram + penalty * np.diag([0.0, *[1.0] * (k - 1)]), right)


def ridge_score(fit: Fit, features: list[str]) -> Column:
    """The fitted value of a row."""
    mean, scale, weights = fit
    out = F.lit(float(weights[0]))
    for c, m, s, w in zip(features, mean, scale, weights[1:], strict=True):
        out = out + (F.col(c).cast("double") - float(m)) / float(s) * float(w)
    return out


def ridge(rows: DataFrame, target: str, features: list[str], penalty: float = 1.0, pool: str | None = None) -> DataFrame:
    """``feature, mean, scale, weight`` of :func:`fit_ridge`, the intercept
    with a mean of 0 and a scale of 1."""
    mean, scale, weights = fit_ridge(rows, target, features, penalty, pool)
    out = [("intercept", 0.0, 1.0, float(weights[0]))] + [(c, float(m), float(s), float(w)) for c, m, s, w in zip(features, mean, scale, weights[1:], strict=True)]
    return rows.sparkSession.createDataFrame([(c, *(round(v, 9) for v in r)) for c, *r in out], "feature string, mean double, scale double, weight double")


def leave_one_out(rows: DataFrame, book: str, target: str, features: list[str], *, unit: str, penalty: float = 1.0) -> DataFrame:
    """``book, unit, score, margin, target, proposed``: the best candidate of
    each unit by a model that never saw its book, proposed where it leads by
    more than any wrong best candidate of the training books did (the gate with
    no wrong training proposal).

    The books are few; a model is fitted for each in turn."""
    books = sorted(r[0] for r in rows.select(book).distinct().collect())
    out = None
    for name in books:
        training, held = rows.where(F.col(book) != F.lit(name)), rows.where(F.col(book) == F.lit(name))
        fit = fit_ridge(training, target, features, penalty, unit)

        def best(df: DataFrame, fit: Fit = fit) -> DataFrame:
            scored = df.withColumn("_s", ridge_score(fit, features))
            top = scored.groupBy(book, unit).agg(F.array_sort(F.collect_list(F.struct((-F.col("_s")).alias("s"), (-F.col(target)).alias("t")))).alias("v"))
            first, second = F.col("v")[0], F.try_element_at("v", F.lit(2))
            return top.select(book, unit, (-first["s"]).alias("score"), (F.coalesce(second["s"], first["s"] + 1e9) - first["s"]).alias("margin"), (-first["t"]).alias("target"))

        gate = best(training).where("target <= 0").agg(F.max("margin")).first()[0]
        part = best(held).withColumn("proposed", F.col("margin") > F.lit(float(gate if gate is not None else 0.0)))
        out = part if out is None else out.unionByName(part)
    return out
