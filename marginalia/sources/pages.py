"""Page observations: validated scans, completeness, staged publishing, and
the grouping of recognised words into rows."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROW = "struct<text: string, bbox: array<double>, confidence: double, column: int>"
PAGE = f"page int, width double, height double, lines array<{ROW}>"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per page; anything that doesn't parse fails the read."""
    return spark.read.schema(PAGE).option("mode", "FAILFAST").option("multiLine", "true").json(path)


def problem() -> Column:
    """The first thing wrong with a page observation, null for a valid one:
    finite positive sizes, ordered boxes inside the page, confidences in 0..1."""

    def finite(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))

    box = lambda r: r["bbox"]
    ordered = lambda r: (F.size(box(r)) == 4) & F.forall(box(r), lambda v: finite(v) & (v >= 0) & (v <= 1)) & (box(r)[0] <= F.get(box(r), 2)) & (F.get(box(r), 1) <= F.get(box(r), 3))
    return (
        F.when(F.col("page").isNull() | (F.col("page") < 1), "page")
        .when(~finite(F.col("width")) | (F.col("width") <= 0) | ~finite(F.col("height")) | (F.col("height") <= 0), "size")
        .when(F.col("lines").isNull(), "lines")
        .when(F.exists("lines", lambda r: r["text"].isNull()), "text")
        .when(F.exists("lines", lambda r: ~F.coalesce(ordered(r), F.lit(False))), "bbox")
        .when(F.exists("lines", lambda r: r["confidence"].isNotNull() & ~r["confidence"].between(0, 1)), "confidence")
    )


def missing_pages(pages: DataFrame, count: int) -> DataFrame:
    """Pages of 1..count that have no valid observation."""
    wanted = pages.sparkSession.range(1, count + 1).select(F.col("id").cast("int").alias("page"))
    return wanted.join(pages.where(problem().isNull()).select("page"), "page", "left_anti")


def rows(pages: DataFrame) -> DataFrame:
    """``page, pos, text, x0, y0, x1, y1, confidence, col`` of valid pages."""
    cut = pages.where(problem().isNull()).select("page", F.posexplode("lines").alias("pos", "r"))
    return cut.select("page", "pos", "r.text", *[F.col("r.bbox")[i].alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))], "r.confidence", F.coalesce("r.column", F.lit(0)).alias("col"))


def preflight(pages: DataFrame, count: int, provenance: str, expected: str) -> DataFrame:
    """``page, problem`` of a cache of page observations: the wrong source
    (page null), missing, repeated and invalid pages; empty for a complete one."""
    spark = pages.sparkSession
    checked = pages.select("page", problem().alias("problem"))
    wanted = spark.range(1, count + 1).select(F.col("id").cast("int").alias("page"))
    missing = wanted.join(checked.select("page"), "page", "left_anti").withColumn("problem", F.lit("missing"))
    repeated = checked.groupBy("page").agg(F.count("*").alias("n")).where("n > 1").select("page", F.lit("repeated").alias("problem"))
    beyond = checked.where(~F.col("page").between(1, count)).select("page", F.lit("unknown-page").alias("problem"))
    found = checked.where("problem is not null").unionByName(missing).unionByName(repeated).unionByName(beyond)
    if provenance != expected:
        found = found.unionByName(spark.sql("select cast(null as int) as page, 'other-source' as problem"))
    return found


def text_column(x0: Column, y0: Column, split: Column, start: Column) -> Column:
    """0 without a split of the page, -1 above where its columns start, else 0
    left and 1 right of the split."""
    above = (F.coalesce(start, F.lit(0.0)) > 0) & (y0 < start)
    return F.when(split.isNull(), 0).when(above, -1).otherwise((x0 > split).cast("int"))


def page_clips(pages: DataFrame) -> DataFrame:
    """``page, clip, x0, y0, x1, y1``: what to read of a page: all of it, or
    its two columns, and what is above them first.
    ``pages(page, split, start)`` in shares of the page."""
    box = lambda *v: F.struct(*[F.lit(x).cast("double").alias(n) if not isinstance(x, Column) else x.cast("double").alias(n) for x, n in zip(v, ("x0", "y0", "x1", "y1"), strict=True)])
    split, start = F.col("split"), F.coalesce("start", F.lit(0.0))
    columns = F.array(box(0.0, start, split, 1.0), box(split, start, 1.0, 1.0))
    clips = F.when(split.isNull(), F.array(box(0.0, 0.0, 1.0, 1.0))).when(start > 0, F.concat(F.array(box(0.0, 0.0, 1.0, start)), columns)).otherwise(columns)
    return pages.select("page", F.posexplode(clips).alias("clip", "b")).select("page", "clip", "b.*")


def page_box(box: list[Column], clip: list[Column]) -> list[Column]:
    """A box in shares of a clip as shares of the page."""
    wide, high = clip[2] - clip[0], clip[3] - clip[1]
    return [clip[0] + box[0] * wide, clip[1] + box[1] * high, clip[0] + box[2] * wide, clip[1] + box[3] * high]


def embedded_rows(spans: DataFrame, sizes: DataFrame) -> DataFrame:
    """``page, line, text, x0, y0, x1, y1, col, confidence`` of a document's own
    text: the spans of a line joined, boxes as shares of the page.

    ``spans(page, line, seq, text, x0, y0, x1, y1)`` in points,
    ``sizes(page, width, height, split, start)``."""
    joined = spans.groupBy("page", "line").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda s: s["text"]), "").alias("text"), *[f(c).alias(c) for c, f in (("x0", F.min), ("y0", F.min), ("x1", F.max), ("y1", F.max))]
    )
    rows = joined.join(sizes, "page")
    scaled = rows.select("page", "line", "text", *[(F.col(c) / F.col("width" if c[0] == "x" else "height")).alias(c) for c in ("x0", "y0", "x1", "y1")], "split", "start")
    return scaled.select("page", "line", "text", "x0", "y0", "x1", "y1", text_column(F.col("x0"), F.col("y0"), F.col("split"), F.col("start")).alias("col"), F.lit(0.0).alias("confidence"))


def publish(df: DataFrame, path: str, check: Column) -> str:
    """Writes a new version below ``path``, checks every row there, then swaps
    the pointer to it in one rename; returns the version's folder.  Rows that
    fail leave the pointer, and the version it names, as they were."""
    spark, base = df.sparkSession, path.rstrip("/")
    version = f"{base}/version-{uuid.uuid4().hex}"
    df.write.parquet(version)
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    folder = hadoop.Path(version)
    files = folder.getFileSystem(conf)
    if not spark.read.parquet(version).where(~F.coalesce(check, F.lit(False))).isEmpty():
        files.delete(folder, True)
        raise ValueError(f"rows fail the check; {path} is unchanged")
    pointer = hadoop.Path(f"{base}/_pointer-{uuid.uuid4().hex}")
    out = files.create(pointer, True)
    out.write(bytearray(version.encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    hadoop.FileContext.getFileContext(files.getUri(), conf).rename(pointer, hadoop.Path(f"{base}/CURRENT"), options)
    return version


def published(spark: SparkSession, path: str) -> DataFrame:
    """The version that the pointer names."""
    name = spark.read.format("binaryFile").load(f"{path.rstrip('/')}/CURRENT").select(F.col("content").cast("string")).first()[0]
    return spark.read.parquet(name)


def words_to_rows(words: DataFrame, by: list[str], order: str) -> DataFrame:
    """Recognised words joined into rows: text by spaces in order, mean
    confidence, united boxes.  ``words(text, confidence, x0, y0, x1, y1)``."""
    return words.groupBy(*by).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "text"))), lambda w: w["text"]), " ").alias("text"),
        F.round(F.avg("confidence"), 6).alias("confidence"),
        F.min("x0").alias("x0"),
        F.min("y0").alias("y0"),
        F.max("x1").alias("x1"),
        F.max("y1").alias("y1"),
    )


def append_log(df: DataFrame, path: str) -> None:
    """Appends rows to a JSON-lines log."""
    df.write.mode("append").json(path)
