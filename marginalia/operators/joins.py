"""Nearest, interval, band, binding, ledger, overlay and closure joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions import text as X
from marginalia.sources.settle import settled


#: How many times ``reach`` a bucket of :func:`bucketed` is wide.
_WIDE = 32
_BUCKET = ("_by", "_bucket")


def bucketed(places: DataFrame, kinds: list[str], reach: float) -> DataFrame:
    """``places`` in buckets of places, sorted, for :func:`beside`: a row that
    is of a kind and near a bucket's edge goes into both, its ``_left`` into one.

    ``places(_by, _at, _id, _left, <kinds>)``: a row that asks has a struct
    ``_left``, one that is of a kind has a value there; others have nulls."""
    place = F.col("_at").cast("double")
    cut = lambda c: F.floor(c / (_WIDE * reach))
    of_kind = reduce(lambda a, b: a | b, [F.col(k).isNotNull() for k in kinds])
    both = F.when(of_kind, F.sequence(cut(place - 1.5 * reach), cut(place + 1.5 * reach)))  # more than reach, for rounding
    rows = places.where(of_kind | F.col("_left").isNotNull()).withColumn("_bucket", F.explode(F.coalesce(both, F.array(cut(place)))))
    rows = rows.withColumn("_left", F.when(F.col("_bucket").eqNullSafe(cut(place)), F.col("_left")))
    return rows.repartition(*_BUCKET).sortWithinPartitions(*_BUCKET, "_at", "_id")


def beside(rows: DataFrame, kinds: list[str], reach: float) -> DataFrame:
    """Rows of :func:`bucketed` where each of ``kinds`` holds the nearest row
    of that kind with the same ``_by`` less than ``reach`` away, as a struct of
    ``gap``, ``id`` and ``m``, the value it has there; or null.  Ties go to the
    least id.

    The nearest is the last of the kind in the order of places or the next one,
    so rows are sorted and no pairs are made, however many are near each other.
    Several calls on the same buckets share a shuffle and a sort.
    """
    names, in_order = ", ".join(_BUCKET), "ORDER BY _at, _id"
    before = {f"_last_{k}": F.expr(f"lag(IF({k} IS NOT NULL, _at, NULL), 1) IGNORE NULLS OVER (PARTITION BY {names} {in_order})") for k in kinds}
    # Of rows at one place the first, which has the least id, stands for all.
    rows = rows.withColumns(before).withColumns({k: F.when(F.col(k).isNotNull() & ~F.col("_at").eqNullSafe(F.col(f"_last_{k}")), F.struct("_at", F.col("_id").alias("id"), F.col(k).alias("m"))) for k in kinds})
    near = {}
    for k in kinds:
        gap = lambda c: F.abs(F.col("_at") - c["_at"])
        near[k] = F.least(*[F.when(F.col("_by").isNotNull() & (gap(c) < reach), F.struct(gap(c).alias("gap"), c["id"].alias("id"), c["m"].alias("m"))) for c in (F.col(f"_last_{k}"), F.col(f"_next_{k}"))])
    return _around(rows, kinds).withColumns(near).drop(*[f"_{way}_{k}" for k in kinds for way in ("last", "next")])


def without(rows: DataFrame, kind: str, reach: float) -> DataFrame:
    """Rows of :func:`bucketed` in buckets where one asks that has no row of
    ``kind`` less than ``reach`` away; the others no longer ask."""
    near = lambda c: F.abs(F.col("_at") - F.col(c)) < reach
    met = F.col("_by").isNotNull() & (F.coalesce(near(f"_last_{kind}"), F.lit(False)) | F.coalesce(near(f"_next_{kind}"), F.lit(False)))
    found = _around(rows.withColumn(kind, F.when(F.col(kind).isNotNull(), F.col("_at"))), [kind]).withColumn("_left", F.when(~met, F.col("_left"))).drop(kind, f"_last_{kind}", f"_next_{kind}")
    return found.withColumn("_any", F.max(F.col("_left").isNotNull()).over(Window.partitionBy(*_BUCKET))).where("_any").drop("_any")


def _around(rows: DataFrame, kinds: list[str]) -> DataFrame:
    """For each of ``kinds`` its last value up to a row's place, and the next."""
    order = Window.partitionBy(*_BUCKET).orderBy("_at")
    last = {f"_last_{k}": F.last(k, ignorenulls=True).over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow)) for k in kinds}
    return rows.withColumns(last | {f"_next_{k}": F.expr(f"lead({k}, 1) IGNORE NULLS OVER (PARTITION BY {', '.join(_BUCKET)} ORDER BY _at)") for k in kinds})


def nearest(left: DataFrame, right: DataFrame, by: str, left_at: str, right_at: str, reach: float, left_id: str, right_id: str) -> DataFrame:
    """Per left row the nearest right row of the same ``by`` less than
    ``reach`` away, ties to the least id; left rows without one keep nulls.
    Both are shuffled once; see :func:`beside`."""
    own = left.select(F.col(by).alias("_by"), F.col(left_at).alias("_at"), F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_left"))
    peers = right.select(F.col(by).alias("_by"), F.col(right_at).alias("_at"), F.col(right_id).alias("_id"), F.lit(True).alias("near"))
    met = beside(bucketed(own.unionByName(peers, allowMissingColumns=True), ["near"], reach), ["near"], reach)
    return met.where("_left is not null").select("_left.*", F.col("near.id").alias("nearest_id"), F.col("near.gap").alias("gap"))


def _in_buckets(rows: DataFrame, width: int) -> DataFrame:
    """A row for each stretch of ``width`` places that a span touches."""
    last = F.greatest(F.col("stop") - 1, F.col("start"))
    return rows.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor(last / width))))


def within(spans: DataFrame, containers: DataFrame, by: str, width: int = 4096) -> DataFrame:
    """Spans with the containers of the same ``by`` that hold them whole; they
    meet in the stretch where the span starts."""
    a = spans.withColumn("_bucket", F.floor(F.col("start") / width)).alias("a")
    b = _in_buckets(containers, width).alias("b")
    met = a.join(b, (F.col(f"a.{by}") == F.col(f"b.{by}")) & (F.col("a._bucket") == F.col("b._bucket")))
    return met.where((F.col("b.start") <= F.col("a.start")) & (F.col("b.stop") >= F.col("a.stop")))


def overlapping(spans: DataFrame, others: DataFrame, by: str, width: int = 4096) -> DataFrame:
    """Pairs of spans of the same ``by`` that share at least one place, once
    each: in the first stretch that both touch."""
    a, b = _in_buckets(spans, width).alias("a"), _in_buckets(others, width).alias("b")
    met = a.join(b, (F.col(f"a.{by}") == F.col(f"b.{by}")) & (F.col("a._bucket") == F.col("b._bucket")))
    first = F.floor(F.greatest(F.col("a.start"), F.col("b.start")) / width) == F.col("a._bucket")
    return met.where((F.col("b.stop") > F.col("a.start")) & (F.col("b.start") < F.col("a.stop")) & first)


def only_container(met: DataFrame, key: list[str], value: str) -> DataFrame:
    """Of spans joined with containers, those with exactly one."""
    return met.groupBy(*[F.col(k) for k in key]).agg(F.min(value).alias(value.rpartition(".")[2]), F.count("*").alias("_n")).where("_n = 1").drop("_n")


def unique_match(left: DataFrame, right: DataFrame, by: str, at: str, reach: float, key: str) -> DataFrame:
    """``key, match``: left rows with exactly one other row of the right side
    at most ``reach`` away, nothing else."""
    a = left.select(key, by, F.col(at).alias("_at"), F.floor(F.col(at) / reach).alias("_bucket"))
    near = F.array(*[F.floor(F.col(at) / reach) + k for k in (-1, 0, 1)])
    b = right.select(F.col(key).alias("_other"), F.col(by).alias("_by"), F.col(at).alias("_place"), F.explode(near).alias("_b"))
    met = a.join(b, (F.col(by) == F.col("_by")) & (F.col("_bucket") == F.col("_b")) & (F.col(key) != F.col("_other")) & (F.abs(F.col("_at") - F.col("_place")) <= reach))
    return met.groupBy(key).agg(F.count("*").alias("_n"), F.min("_other").alias("match")).where("_n = 1").drop("_n")


def in_band(rows: DataFrame, peers: DataFrame, page: str = "page", below: float = 0.002, left: float = 0.035, right: float = 0.05) -> DataFrame:
    """Rows with the peers of their page whose centre lies in them and whose
    edges are theirs.  Both have ``page, x0, y0, x1, y1``; peers' columns get
    a ``peer_`` in front."""
    b = peers.select(*[F.col(c).alias(f"peer_{c}") for c in peers.columns])
    centre = (F.col("peer_y0") + F.col("peer_y1")) / 2
    inside = centre.between(F.col("y0"), F.col("y1") + below)
    edges = (F.abs(F.col("peer_x0") - F.col("x0")) < left) & (F.abs(F.col("peer_x1") - F.col("x1")) < right)
    return rows.join(b, (F.col(page) == F.col(f"peer_{page}")) & inside & edges)


def nearby(decisions: DataFrame, rows: DataFrame, page: str = "page", high: float = 0.005, wide: float = 0.15) -> DataFrame:
    """Decisions with the rows of their page whose centre is less than
    ``high`` and ``wide`` away.  Both have ``page, x, y``; rows' columns get a
    ``row_`` in front; they meet in strips of the page."""
    a = decisions.withColumn("_strip", F.floor(F.col("y") / high))
    b = rows.select(*[F.col(c).alias(f"row_{c}") for c in rows.columns])
    b = b.withColumn("_s", F.explode(F.array(*[F.floor(F.col("row_y") / high) + k for k in (-1, 0, 1)])))
    close = (F.abs(F.col("y") - F.col("row_y")) < high) & (F.abs(F.col("x") - F.col("row_x")) < wide)
    return a.join(b, (F.col(page) == F.col(f"row_{page}")) & (F.col("_strip") == F.col("_s")) & close).drop("_strip", "_s")


def bound(decisions: DataFrame, rows: DataFrame) -> DataFrame:
    """``decision_id, row_id, reason``: the one row a decision was made for.

    By the hash of the text; where several rows have it, by the hash of the
    evidence; where several have that too, by the place.  Else a reason:
    text-changed, evidence-changed, ambiguous-place.
    ``decisions(decision_id, text_hash, evidence_hash, place)``,
    ``rows(row_id, text_hash, evidence_hash, place)``."""
    # copies of a row are one, however many there are
    r = rows.groupBy("text_hash", F.col("evidence_hash").alias("_evidence"), F.col("place").alias("_place")).agg(F.count("*").alias("_n"), F.min("row_id").alias("_id"))
    met = decisions.join(r, "text_hash", "left")
    same = F.col("evidence_hash") == F.col("_evidence")
    there = same & (F.col("place") == F.col("_place"))
    count = lambda c: F.coalesce(F.sum(F.when(c, F.col("_n"))), F.lit(0))
    counts = met.groupBy("decision_id").agg(
        count(F.col("_id").isNotNull()).alias("texts"), F.min("_id").alias("one"),
        count(same).alias("evidences"), F.min(F.when(same, F.col("_id"))).alias("two"),
        count(there).alias("places"), F.min(F.when(there, F.col("_id"))).alias("three"),
    )
    row = F.when(F.col("texts") == 1, F.col("one")).when(F.col("evidences") == 1, F.col("two")).when(F.col("places") == 1, F.col("three"))
    reason = F.when(row.isNotNull(), "bound").when(F.col("texts") == 0, "text-changed").when(F.col("evidences") == 0, "evidence-changed").otherwise("ambiguous-place")
    return counts.select("decision_id", row.alias("row_id"), reason.alias("reason"))


def inventory(gold: DataFrame, system: DataFrame, key: str) -> DataFrame:
    """``key, status`` of every id that is not once on both sides: missing,
    unknown, repeated."""
    g = gold.groupBy(F.col(key).alias("_g")).agg(F.count("*").alias("_wanted"))
    s = system.groupBy(F.col(key).alias("_s")).agg(F.count("*").alias("_given"))
    both = g.join(s, F.col("_g") == F.col("_s"), "full_outer")
    status = F.when(F.col("_given").isNull(), "missing").when(F.col("_wanted").isNull(), "unknown").when((F.col("_wanted") > 1) | (F.col("_given") > 1), "repeated")
    return both.select(F.coalesce("_g", "_s").alias(key), status.alias("status")).where("status is not null")


def redirected(terms: DataFrame, redirects: DataFrame, pages: DataFrame) -> DataFrame:
    """``term, title, target``: a term's page after up to two redirects, its
    first letter being capital without any; disambiguation pages give nothing.

    ``redirects(source, target)``, ``pages(title, target_title, disambiguation)``."""
    hop = lambda n: redirects.select(F.col("source").alias(f"_s{n}"), F.col("target").alias(f"_t{n}"))
    capital = F.concat(F.upper(F.substring("term", 1, 1)), F.substr("term", F.lit(2)))
    one = terms.select("term").join(hop(1), F.col("term") == F.col("_s1"), "left").withColumn("_one", F.coalesce("_t1", capital))
    two = one.join(hop(2), F.col("_one") == F.col("_s2"), "left").withColumn("title", F.coalesce("_t2", "_one"))
    known = pages.where("not disambiguation and target_title is not null").select("title", F.col("target_title").alias("target"))
    return two.join(known, "title").select("term", "title", "target")


def missing_numbers(rows: DataFrame, by: str, number: str) -> DataFrame:
    """Absent numbers in 1..max with the nearest present ones on both sides."""
    seen = rows.select(by, F.col(number).cast("int").alias("number")).distinct()
    order = Window.partitionBy(by).orderBy("number")
    edges = seen.select(by, F.lag("number", 1, 0).over(order).alias("lower"), F.col("number").alias("upper")).where("upper - lower > 1")
    gaps = edges.select(by, F.explode(F.sequence(F.col("lower") + 1, F.col("upper") - 1)).alias("number"), "lower", "upper")
    return gaps.withColumn("lower", F.when(F.col("lower") > 0, F.col("lower")))


def coverage(rows: DataFrame, uses: DataFrame, key: str, excluded: Column) -> DataFrame:
    """A full ledger of how often each row is used against how often it must
    be: at least once, or never where excluded; unknown uses are errors."""
    counts = uses.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("mapped"))
    joined = rows.select(key, excluded.alias("excluded")).join(counts, F.col(key) == F.col("_key"), "full_outer")
    mapped = F.coalesce("mapped", F.lit(0))
    status = (
        F.when(F.col(key).isNull(), "unknown")
        .when(F.col("excluded") & (mapped > 0), "excluded-but-used")
        .when(F.col("excluded"), "excluded")
        .when(mapped == 0, "missing")
        .otherwise("covered")
    )
    return joined.select(F.coalesce(key, "_key").alias(key), mapped.alias("mapped"), status.alias("status"))


def checked_edits(rows: DataFrame, edits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Applies edits to pages where they match as often as they say.

    ``rows(page, pos, text)``, ``edits(seq, page, before, after, count)`` with
    optional ``whole_word``, ``exact_row``, ``prefix`` and ``suffix`` (booleans,
    as in :func:`text.edit_pattern`).  A page's edits are made in order of
    ``seq``, each counted on what the ones before it left; one that does not
    match is skipped.  Returns the edited rows and a report of every edit."""
    flag = lambda n: F.coalesce(F.col(n), F.lit(False)) if n in edits.columns else F.lit(False)
    plain = X.edit_pattern(F.col("before"))
    whole = F.when(flag("exact_row"), X.edit_pattern(F.col("before"), exact_row=True)).when(flag("whole_word"), X.edit_pattern(F.col("before"), whole_word=True)).otherwise(plain)
    pattern = F.concat(F.when(flag("prefix"), r"\A").otherwise(""), whole, F.when(flag("suffix"), r"\z").otherwise(""))
    literal = F.replace(F.replace(F.col("after"), F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))
    steps = edits.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("seq", F.col("count").cast("long").alias("count"), pattern.alias("p"), literal.alias("r")))).alias("steps"))
    pages = rows.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("pos", "text"))).alias("rows"))
    joined = steps.join(pages, "page", "left")
    texts = F.coalesce(F.transform("rows", lambda r: r["text"]), F.array().cast("array<string>"))
    none = F.array().cast("array<struct<seq:int,matches:bigint>>")

    def step(state: Column, edit: Column) -> Column:
        n = F.aggregate(F.transform(state["t"], lambda t: F.regexp_count(t, edit["p"]).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
        made = F.when(n == edit["count"], F.transform(state["t"], lambda t: F.regexp_replace(t, edit["p"], edit["r"]))).otherwise(state["t"])
        return F.struct(made.alias("t"), F.concat(state["n"], F.array(F.struct(edit["seq"].cast("int").alias("seq"), n.alias("matches")))).alias("n"))

    done = joined.withColumn("_d", F.aggregate("steps", F.struct(texts.alias("t"), none.alias("n")), step))
    made = done.where("rows is not null").select("page", F.explode(F.arrays_zip(F.transform("rows", lambda r: r["pos"]).alias("pos"), F.col("_d.t").alias("text"))).alias("r")).select("page", "r.pos", "r.text")
    counts = done.select(F.col("page").alias("_page"), F.explode("_d.n").alias("n")).select("_page", F.col("n.seq").alias("_seq"), "n.matches")
    report = edits.join(counts, (F.col("page") == F.col("_page")) & (F.col("seq") == F.col("_seq"))).drop("_page", "_seq").withColumn("applied", F.col("matches") == F.col("count"))
    rest = rows.select("page", "pos", "text").join(steps.select("page"), "page", "left_anti")
    return rest.unionByName(made), report


def conflicts(spans: DataFrame, by: str) -> DataFrame:
    """Spans that begin before an earlier span of the same ``by`` ends."""
    order = Window.partitionBy(by).orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    return spans.withColumn("reach", F.max("stop").over(order)).where("start < reach")


def merged(first: DataFrame, second: DataFrame, key: list[str]) -> DataFrame:
    """Two ranked suggestion lists: generators united, and evidence where both
    have it; the first's rank goes ahead."""
    lists = [c for c in ("generators", "evidence") if c in first.columns and c in second.columns]
    b = second.select(*[F.col(k).alias(f"_{k}") for k in key], F.col("rank").alias("_rank"), *[F.col(c).alias(f"_{c}") for c in lists])
    same = reduce(Column.__and__, [F.col(k) == F.col(f"_{k}") for k in key])
    joined = first.join(b, same, "full_outer")
    empty = F.array().cast("array<string>")
    return joined.select(
        *[F.coalesce(k, f"_{k}").alias(k) for k in key],
        *[F.array_sort(F.array_union(F.coalesce(c, empty), F.coalesce(f"_{c}", empty))).alias(c) for c in lists],
        F.coalesce("rank", F.col("_rank") + 1000).alias("rank"),
    )


def roots(links: DataFrame, node: str, parent: str) -> DataFrame:
    """``node, root``: each node's root by pointer doubling, whatever the
    depth; null for nodes that lead into a cycle or to an unknown parent.

    A round doubles how far every pointer reaches, so it settles some node
    while any that has a root is left; the first round that settles none ends
    the iteration."""
    state = settled(links.select(F.col(node).alias("node"), F.col(parent).alias("up"), F.when(F.col(parent).isNull(), F.col(node)).alias("root")))
    done = -1
    while (n := state.where("root is not null").count()) > done:
        done = n
        above = state.select(F.col("node").alias("_n"), F.col("up").alias("_up"), F.col("root").alias("_root"))
        met = state.join(above, F.col("root").isNull() & (F.col("up") == F.col("_n")), "left")
        state = settled(met.select("node", F.coalesce("_up", "up").alias("up"), F.coalesce("root", "_root").alias("root")))
    return state.select("node", "root")


def reached(starts: DataFrame, edges: DataFrame) -> DataFrame:
    """``node``: everything that ``edges(source, target)`` lead to from
    ``starts(node)``, those included; a round follows new nodes only."""
    seen = front = settled(starts.select("node").distinct())
    while not front.isEmpty():
        ahead = edges.join(front, F.col("source") == F.col("node")).select(F.col("target").alias("node")).distinct()
        front = settled(ahead.join(seen, "node", "left_anti"))
        seen = settled(seen.unionByName(front))
    return seen


def unused(nodes: DataFrame, starts: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes that nothing leads to from the starts."""
    return nodes.select("node").join(reached(starts, edges), "node", "left_anti")
