"""Benchmark decontamination as a prefix-filtered set join, in DataFrame
operations only.

Each benchmark item is cut into windows of consecutive words.  A document
holds a window only if it holds all of its words, so the necessary prefix of a
window under any order is one word; with words ordered by rarity over all
documents that is its rarest.  Document positions are joined to windows on
this word, bounds on position and length drop what can't fit, and exact
equality over the item-sized window decides.

Windows are broadcast in blocks of :data:`BLOCK` rows and
:data:`BLOCK_BYTES` bytes at most, so the broadcast size is bounded whatever the
benchmark's size; each block is one pass over the documents.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.native_text import letter_words, text_hash
from marginalia.llm.storage import free_name, materialize

WINDOW_WORDS = 10
#: Windows of one broadcast block, and bytes of their texts.
BLOCK, BLOCK_BYTES = 100_000, 15_000_000


def windows(benchmark: DataFrame, *, text: str = "text", item: str = "item_id", words: int = WINDOW_WORDS) -> DataFrame:
    """``item, win``: every window of ``words`` words; a shorter item, but
    not one without words, is one window."""
    cut = benchmark.select(F.col(item).cast("string").alias("item"), letter_words(F.col(text)).alias("w")).where("size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (words - 1), F.lit(1)))
    return cut.select("item", "w", F.explode(starts).alias("s")).select("item", F.array_join(F.slice("w", F.col("s"), words), " ").alias("win")).distinct()


def _blocks(docs: DataFrame, wins: DataFrame, text: str) -> list[DataFrame]:
    """Windows with their rarest word, its place and their length."""
    distinct = wins.select("win").distinct().select("win", F.split("win", " ").alias("w"))
    placed = distinct.select("win", F.size("w").alias("len"), F.posexplode("w").alias("off", "word"))
    vocabulary = placed.select("word").distinct()
    seen = docs.select(F.explode(letter_words(F.col(text))).alias("word"))
    n = vocabulary.count()
    if n > BLOCK:
        counts = seen.groupBy("word").agg(F.count("*").alias("n")).join(vocabulary, "word", "left_semi")
    else:
        counts = seen.join(F.broadcast(vocabulary), "word", "left_semi").groupBy("word").agg(F.count("*").alias("n"))
    rarest = (
        placed.join(counts, "word", "left")
        .groupBy("win", "len")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "off")).alias("r"))
        .where("r.n > 0")  # else no document has the word
        .select(F.xxhash64("win").alias("win_id"), "win", "len", F.col("r.word").alias("word"), F.col("r.off").alias("off"))
    )
    rarest = materialize(rarest, "windows")
    size = rarest.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("win")), F.lit(0)).alias("b")).first()
    parts = max(1, -(-size["n"] // BLOCK), -(-size["b"] // BLOCK_BYTES))
    if parts == 1:
        return [rarest]
    # hashed blocks vary a little; aim below the bound
    parts = -(-parts * 5 // 4)
    return [rarest.where(F.pmod("win_id", F.lit(parts)) == i) for i in range(parts)]


def _contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    key: str = "doc_id",
    item: str = "item_id",
    item_text: str = "text",
    words: int = WINDOW_WORDS,
) -> DataFrame:
    """The columns of :func:`contamination`, with ``th``, a hash of the text."""
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    wins = materialize(windows(benchmark, text=item_text, item=item, words=words), "items")
    cut = docs.select("key", text_hash(F.col("text")).alias("th"), letter_words(F.col("text")).alias("w"))
    # place 0 stands for the document itself
    places = cut.select("key", "th", "w", F.posexplode(F.concat(F.array(F.lit("")), F.col("w"))).alias("pos", "word"))
    found = []
    for i, block in enumerate(_blocks(docs, wins, "text")):
        start = F.col("pos") - F.col("off")
        fits = (
            (F.col("p.word") == F.col("b.word"))
            & (start >= 1)
            & (start + F.col("len") <= F.size("w") + 1)
            & (F.array_join(F.slice("w", start, F.col("len")), " ") == F.col("win"))
        )
        joined = places.alias("p").join(F.broadcast(block.alias("b")), fits, "left")
        found.append(
            joined.where("win_id is not null" if i else "pos = 0 or win_id is not null").select(
                "key",
                "th",
                F.when(F.col("pos") == 0, F.size("w").cast("long")).alias("n_words"),
                F.when(F.col("win_id").isNotNull(), F.struct(start.alias("a"), (start + F.col("len")).alias("z"))).alias("span"),
                "win_id",
            )
        )
    hits = reduce(DataFrame.unionByName, found)
    per = materialize(
        hits.groupBy("key", "th").agg(
            F.count("n_words").alias("copies"),
            F.max("n_words").alias("n_words"),
            F.array_sort(F.collect_set("span")).alias("spans"),
            F.collect_set("win_id").alias("ids"),
        ),
        "hits",
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto")),
        lambda a, x: F.struct(
            (a.n + F.greatest(F.lit(0), x.z - F.greatest(x.a, a.upto))).alias("n"), F.greatest(a.upto, x.z).alias("upto")
        ),
        lambda a: a.n.cast("long"),
    )
    items = (
        per.select("key", "th", F.explode("ids").alias("win_id"))
        .join(wins.where("item is not null").select("item", F.xxhash64("win").alias("win_id")), "win_id")
        .groupBy("key", "th")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    out = per.alias("a").join(items.alias("b"), F.col("a.key").eqNullSafe(F.col("b.key")) & (F.col("a.th") == F.col("b.th")), "left")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        F.col("a.key").alias(key),
        F.col("a.th").alias("th"),
        "n_words",
        covered.alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    ).drop("copy")


def contamination(docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", **options) -> DataFrame:
    """``key, n_words, n_hit, n_items, items_sha256, contaminated`` per row.

    A document word inside any occurrence of a window is hit; ``n_items``
    counts the items with an occurring window, and ``items_sha256`` is the
    digest of their ids, sorted as strings and comma-joined.  Null texts have
    no words and no hits, items without words no windows, null item ids no
    place in the list.  Null keys and repeated rows are returned as they come;
    words of equal rarity stand in for a window by their order; very long texts
    are read whole; other columns are never read; an empty benchmark leaves
    every document clean, an empty table gives no rows.
    """
    return _contamination(docs, benchmark, key=key, **options).drop("th")


def keep_clean(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that hold no window of a benchmark item, each by its
    own text, whatever other rows have its key."""
    name, other = free_name(docs, "bad_key"), free_name(docs, "bad_text")
    found = _contamination(docs, benchmark, text=text, key=key, **options).where("contaminated")
    bad = found.select(F.col(key).alias(name), F.col("th").alias(other)).distinct()
    return docs.join(bad, F.col(key).eqNullSafe(F.col(name)) & (text_hash(F.col(text)) == F.col(other)), "left_anti")
