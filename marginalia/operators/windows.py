"""Ordered-neighbour operators: islands, curves, splits, ranges, contexts."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions import text as X


def islands(rows: DataFrame, by: list[str], order: list[str], breaks: Column, name: str = "island") -> DataFrame:
    """Numbers runs of rows from 1; ``breaks`` is true where a run starts."""
    w = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumn(name, F.sum(F.when(F.coalesce(breaks, F.lit(True)), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def review_curve(rows: DataFrame, score: str, key: str, error: str, budgets: list[int], alarms: list[int]) -> DataFrame:
    """Value of a ranked review queue at budgets of items and of false alarms.

    Ranked by (-score, key).  A budget beyond the queue is clamped; an alarm
    budget takes the longest prefix, possibly empty, with no more false alarms.
    Only as many first rows as the largest budget, and as many first false
    alarms, are taken to the driver; the rest is one aggregation.
    """
    base = rows.select(F.col(score).alias("s"), F.col(key).alias("k"), F.col(error).cast("int").alias("e"))
    order = [F.desc("s"), F.asc("k")]
    first = base.orderBy(*order).limit(max(budgets, default=0)).collect()
    wrong = base.where("e = 0").orderBy(*order).limit(max(alarms, default=-1) + 1).collect()
    ends = {a: wrong[a] if a < len(wrong) else None for a in alarms}  # the false alarm that is too many
    ahead = {a: F.lit(True) if w is None else (F.col("s") > w.s) | ((F.col("s") == w.s) & (F.col("k") < w.k)) for a, w in ends.items()}
    whole = base.agg(
        F.coalesce(F.sum("e"), F.lit(0)).alias("all"),
        *[F.count_if(inside).alias(f"n{a}") for a, inside in ahead.items()],
        *[F.coalesce(F.sum(F.when(inside, F.col("e"))), F.lit(0)).alias(f"e{a}") for a, inside in ahead.items()],
    ).first()
    found = [("items", b, min(b, len(first)), sum(r.e for r in first[:b])) for b in budgets]
    found += [("false_alarms", a, whole[f"n{a}"], whole[f"e{a}"]) for a in alarms]
    out = rows.sparkSession.createDataFrame([(*f, whole["all"]) for f in found], "kind string, budget int, reviewed long, found long, total long")
    return out.select(
        "kind",
        "budget",
        "reviewed",
        "found",
        F.round(F.try_divide(F.col("found").cast("double"), F.col("reviewed")), 6).alias("precision"),
        F.round(F.try_divide(F.col("found").cast("double"), F.col("total")), 6).alias("recall"),
    )


def ranked(rows: DataFrame, by: str, order: list[str], bucket: Column) -> DataFrame:
    """``rows`` with ``_k``, their place from 1 in the order within ``by``, and
    ``_n``, the number of rows there.

    ``bucket`` cuts the order into ranges that grow with it; places are counted
    within a range and moved by the sizes of the ranges before it, so a large
    group is spread over its ranges."""
    cut = rows.withColumn("_bucket", bucket)
    sizes = cut.groupBy(F.col(by).alias("_by"), F.col("_bucket").alias("_b")).agg(F.count("*").alias("_size"))
    ahead = Window.partitionBy("_by").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(ahead), F.lit(0))).withColumn("_n", F.sum("_size").over(Window.partitionBy("_by")))
    placed = cut.withColumn("_place", F.row_number().over(Window.partitionBy(by, "_bucket").orderBy(*order)))
    met = placed.join(sizes, F.col(by).eqNullSafe(F.col("_by")) & F.col("_bucket").eqNullSafe(F.col("_b")))
    return met.withColumn("_k", F.col("_before") + F.col("_place")).drop("_bucket", "_b", "_by", "_size", "_before", "_place")


def forward_split(rows: DataFrame, by: str, page: str, width: int = 65_536) -> DataFrame:
    """``seed``: whether the page, a number, is among the first fifth, one at
    least, of the distinct pages of its group."""
    pages = ranked(rows.select(by, page).distinct(), by, [page], F.floor(F.col(page) / width))
    marked = pages.select(F.col(by).alias("_by"), F.col(page).alias("_page"), (F.col("_k") <= F.greatest(F.lit(1), F.expr("(_n + 4) div 5"))).alias("seed"))
    return rows.join(marked, (F.col(by) == F.col("_by")) & (F.col(page) == F.col("_page"))).drop("_by", "_page")


def ranges(starts: DataFrame, by: str, start: str, last: Column) -> DataFrame:
    """``stop``: one before the next start, or ``last``."""
    ahead = F.lead(start).over(Window.partitionBy(by).orderBy(start))
    return starts.withColumn("stop", F.coalesce(ahead - 1, last))


def recent(rows: DataFrame, by: str, order: str, size: Column, limit: int) -> DataFrame:
    """How many earlier rows fit into a context of ``limit`` characters, most
    recent first: those from the first place on that is at most ``limit``
    before this one, by a range frame over the running size."""
    w = Window.partitionBy(by).orderBy(order)
    placed = rows.withColumn("_at", F.coalesce(F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")).withColumn("_k", F.row_number().over(w))
    frame = Window.partitionBy(by).orderBy("_at").rangeBetween(-limit, 0)
    return placed.withColumn("context_rows", (F.col("_k") - F.min("_k").over(frame)).cast("int")).drop("_at", "_k")


def neighbours(lines: DataFrame) -> DataFrame:
    """``doc_id, pos, sentence, idx, term, before, after``: each word of a line
    with the words beside it, null across a sentence mark."""
    cut = lines.select("doc_id", "pos", F.posexplode(F.split("line", "[.!?;]")).alias("sentence", "part"))
    words = cut.select("doc_id", "pos", "sentence", F.posexplode(X.tokens(F.lower("part"))).alias("idx", "term"))
    w = Window.partitionBy("doc_id", "pos", "sentence").orderBy("idx")
    return words.withColumn("before", F.lag("term").over(w)).withColumn("after", F.lead("term").over(w))


def stratified(rows: DataFrame, by: str, order: str, width: int = 65_536) -> DataFrame:
    """First, middle (n div 2) and last row of each class, by a number."""
    numbered = ranked(rows, by, [order], F.floor(F.col(order) / width))
    return numbered.where("_k = 1 or _k = _n div 2 + 1 or _k = _n").drop("_k", "_n")


def greedy_chunks(rows: DataFrame, by: str, order: str, size: Column, limit: int, most: int | None = None) -> DataFrame:
    """Packs rows in order into chunks of at most ``limit``, and of at most
    ``most`` rows; a longer row is a chunk of its own.  Only sizes are
    gathered."""

    @F.pandas_udf("array<bigint>")
    def chunks(sizes: pd.Series) -> pd.Series:
        def one(values) -> list[int]:
            out, chunk, used, held = [], 0, 0, 0
            for s in values:
                if held and (used + s > limit or (most is not None and held >= most)):
                    chunk, used, held = chunk + 1, 0, 0
                used, held = used + s, held + 1
                out.append(chunk)
            return out

        return sizes.map(one)

    packed = rows.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.coalesce(size, F.lit(0)).cast("long").alias("s")))).alias("r"))
    numbered = packed.select(by, F.explode(F.arrays_zip(F.transform("r", lambda x: x["o"]).alias("o"), chunks(F.transform("r", lambda x: x["s"])).alias("c"))).alias("p"))
    return numbered.select(by, F.col("p.o").alias(order), F.col("p.c").alias("chunk"))


def queue_order(rows: DataFrame, flags: list[str], order: list[str], error: str, heads: list[int]) -> DataFrame:
    """``reviewed, errors`` of a queue's first rows: rows with the flags come
    first, flag by flag, then by ``order``."""
    first = [F.desc(f) for f in flags] + [F.asc(c) for c in order]
    top = rows.orderBy(*first).limit(max(heads)).select(F.col(error).cast("int").alias("e")).collect()
    out = [(n, min(n, len(top)), sum(r.e for r in top[:n])) for n in heads]
    return rows.sparkSession.createDataFrame(out, "head int, reviewed int, errors int")


def hanging_lists(rows: DataFrame, by: str, order: str) -> DataFrame:
    """``rows`` with ``item``: the number of the list item that a row starts or
    goes on, null outside.  A row that starts with a mark or a number opens an
    item; rows further in than it go on with it; others end it.
    ``rows(text, x0)``."""
    w = Window.partitionBy(by).orderBy(order)
    opens = F.col("text").rlike(r"^\s*(?:[•*–-]|\d{1,3}[.)])\s")
    marked = rows.withColumn("_opens", opens).withColumn("_left", F.last(F.when(opens, F.col("x0")), True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    inside = F.col("_opens") | (F.col("_left").isNotNull() & (F.col("x0") > F.col("_left")))
    runs = marked.withColumn("_in", inside).withColumn("_run", F.sum(F.when(inside, 0).otherwise(1)).over(w))
    number = F.sum(F.col("_opens").cast("int")).over(w)
    begun = F.max(F.col("_opens").cast("int")).over(Window.partitionBy(by, "_run").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return runs.withColumn("item", F.when(F.col("_in") & (begun == 1), number).cast("long")).drop("_opens", "_left", "_in", "_run")


def first_of_each(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in an order; equal orders are one row."""
    return rows.withColumn("_k", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("_k = 1").drop("_k")


def triage(rows: DataFrame, by: str) -> DataFrame:
    """``rows`` with ``rank``, their place in a book's review: rows on which
    three readings agree, then two, then the others, each by page and place.
    ``rows(tier, page, y0)``."""
    tier = F.when(F.col("tier") == "three-peer-consensus", 0).when(F.col("tier") == "fresh-peer-consensus", 1).otherwise(2)
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(tier, "page", "y0")))
