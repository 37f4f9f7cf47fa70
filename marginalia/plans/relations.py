"""Queries over the star schema, the decision feed, labels and vectors."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marginalia.functions import text as X
from marginalia.operators import evaluation, joins, sequence, windows
from marginalia.operators.models import ridge
from marginalia.sources import tables as T
from marginalia.streaming import feeds

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql:
            SQL[name] = sql
        return function

    return add


@query(
    "j1_nearest",
    """WITH e AS (SELECT event_id, user_id, epoch_us(ts) AS t FROM events WHERE event_type = 'error'), p AS (SELECT event_id AS pid, user_id, epoch_us(ts) AS pt FROM events WHERE event_type = 'purchase'),
    m AS (SELECT e.event_id, pid, abs(t - pt) AS gap, row_number() OVER (PARTITION BY e.event_id ORDER BY abs(t - pt), pid) AS k FROM e JOIN p ON e.user_id = p.user_id AND abs(t - pt) < 43200000000)
    SELECT e.event_id, m.pid AS nearest_id, m.gap FROM e LEFT JOIN m ON e.event_id = m.event_id AND m.k = 1""",
)
def nearest(spark, folder):
    e = T.table(spark, folder, "events").select("event_id", "user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    return joins.nearest(e.where("event_type = 'error'"), e.where("event_type = 'purchase'"), "user_id", "t", "t", 43_200_000_000, "event_id", "event_id").select("event_id", "nearest_id", "gap")


@query(
    "j5_missing_numbers",
    """WITH s AS (SELECT DISTINCT l_orderkey, l_linenumber::INT AS n FROM lineitem), e AS (SELECT l_orderkey, lag(n, 1, 0) OVER (PARTITION BY l_orderkey ORDER BY n) AS lo, n AS hi FROM s)
    SELECT l_orderkey, unnest(range(lo + 1, hi))::INT AS number, nullif(lo, 0) AS lower, hi AS upper FROM e WHERE hi - lo > 1""",
)
def missing_numbers(spark, folder):
    return joins.missing_numbers(T.table(spark, folder, "lineitem"), "l_orderkey", "l_linenumber")


@query(
    "j6_gaps",
    """SELECT k AS doc_id FROM (SELECT unnest(range(0, (SELECT max(doc_id) + 1 FROM documents))) AS k) WHERE k NOT IN (SELECT doc_id FROM labels)""",
)
def gaps(spark, folder):
    top = T.table(spark, folder, "documents").agg(F.max("doc_id")).first()[0]
    wanted = spark.range(0, (top if top is not None else -1) + 1).withColumnRenamed("id", "doc_id")
    return wanted.join(T.table(spark, folder, "labels").select("doc_id"), "doc_id", "left_anti")


@query(
    "j8_coverage",
    """WITH u AS (SELECT l_orderkey AS k, count(*) AS mapped FROM lineitem GROUP BY 1)
    SELECT coalesce(o_orderkey, k) AS o_orderkey, coalesce(mapped, 0) AS mapped, CASE WHEN o_orderkey IS NULL THEN 'unknown' WHEN o_orderstatus = 'F' AND coalesce(mapped, 0) > 0 THEN 'excluded-but-used'
    WHEN o_orderstatus = 'F' THEN 'excluded' WHEN coalesce(mapped, 0) = 0 THEN 'missing' ELSE 'covered' END AS status FROM orders FULL JOIN u ON o_orderkey = k""",
)
def coverage(spark, folder):
    uses = T.table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.coverage(T.table(spark, folder, "orders"), uses, "o_orderkey", F.col("o_orderstatus") == "F")


_EDITS = [(1, "src0", "The ", "THE ", 0), (2, "src1", "ion.", "ION.", 12), (3, "src2", "qzx", "none", 0), (4, "src3", "\n", " ", 1)]



@query(
    "j10_binding",
    """WITH h AS (SELECT sha256(text) AS h, min(doc_id) AS f, count(*) AS n FROM documents GROUP BY 1)
    SELECT doc_id, f AS bound_to, CASE WHEN n = 1 THEN 'unique' WHEN doc_id = f THEN 'first-of-copies' ELSE 'copy' END AS reason FROM documents JOIN h ON sha256(text) = h""",
)
def binding(spark, folder):
    docs = T.table(spark, folder, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    groups = docs.groupBy("h").agg(F.min("doc_id").alias("bound_to"), F.count("*").alias("n"))
    reason = F.when(F.col("n") == 1, "unique").when(F.col("doc_id") == F.col("bound_to"), "first-of-copies").otherwise("copy")
    return docs.join(groups, "h").select("doc_id", "bound_to", reason.alias("reason"))


@query(
    "j12_conflicts",
    """WITH s AS (SELECT l_suppkey AS k, l_orderkey AS id, l_linenumber AS n, epoch_us(l_shipdate) // 86400000000 AS start, epoch_us(l_shipdate) // 86400000000 + l_quantity::BIGINT AS stop FROM lineitem),
    r AS (SELECT *, max(stop) OVER (PARTITION BY k ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s) SELECT k, count(*) AS conflicts FROM r WHERE start < reach GROUP BY k""",
)
def conflicts(spark, folder):
    day = F.expr("unix_micros(cast(l_shipdate as timestamp)) div 86400000000")
    spans = T.table(spark, folder, "lineitem").select(F.col("l_suppkey").alias("k"), day.alias("start"), (day + F.col("l_quantity").cast("long")).alias("stop"))
    return joins.conflicts(spans, "k").groupBy("k").agg(F.count("*").alias("conflicts"))


@query(
    "j13_merge",
    """WITH a AS (SELECT c_nationkey AS k, row_number() OVER (ORDER BY c_nationkey) AS rank FROM (SELECT DISTINCT c_nationkey FROM customer)), b AS (SELECT s_nationkey AS k, row_number() OVER (ORDER BY s_nationkey DESC) AS rank FROM (SELECT DISTINCT s_nationkey FROM supplier))
    SELECT coalesce(a.k, b.k) AS k, concat_ws(',', CASE WHEN a.k IS NOT NULL THEN 'customer' END, CASE WHEN b.k IS NOT NULL THEN 'supplier' END) AS generators, coalesce(a.rank, b.rank + 1000)::INT AS rank FROM a FULL JOIN b ON a.k = b.k""",
)
def merge(spark, folder):
    def ranked(name: str, key: str, order) -> DataFrame:
        keys = T.table(spark, folder, name).groupBy(F.col(key).alias("k")).agg(F.lit(1).alias("one"))
        return keys.select("k", F.row_number().over(Window.orderBy(order)).alias("rank"), F.array(F.lit(name)).alias("generators"))  # one row a nation

    out = joins.merged(ranked("customer", "c_nationkey", F.asc("k")), ranked("supplier", "s_nationkey", F.desc("k")), ["k"])
    return out.withColumn("generators", F.array_join("generators", ","))


@query(
    "j20_roots",
    """WITH RECURSIVE p AS (SELECT p_partkey AS node, CASE WHEN p_partkey % 7 = 1 THEN NULL ELSE p_partkey - 1 END AS up FROM part),
    r(node, root) AS (SELECT node, node FROM p WHERE up IS NULL UNION ALL SELECT p.node, r.root FROM p JOIN r ON p.up = r.node) SELECT p.node, r.root FROM p LEFT JOIN r ON p.node = r.node""",
)
def roots(spark, folder):
    links = T.table(spark, folder, "part").select(F.col("p_partkey").alias("node"), F.when(F.col("p_partkey") % 7 != 1, F.col("p_partkey") - 1).alias("up"))
    return joins.roots(links, "node", "up")



@query(
    "a4_detection",
    """WITH b AS (SELECT lang, quality = 0 AS e, n_chars < 400 AS d FROM labels JOIN documents USING (doc_id)),
    c AS (SELECT lang, count(*) FILTER (e AND d) AS tp, count(*) FILTER (NOT e AND d) AS fp, count(*) FILTER (NOT e AND NOT d) AS tn, count(*) FILTER (e AND NOT d) AS fn FROM b GROUP BY ROLLUP (lang))
    SELECT lang, tp, fp, tn, fn, round(tp / nullif(tp + fp, 0)::DOUBLE, 6) AS precision, round(tp / nullif(tp + fn, 0)::DOUBLE, 6) AS recall, round(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 6) AS f1,
    round(1.25 * tp / nullif(1.25 * tp + 0.25 * fn + fp, 0)::DOUBLE, 6) AS f05, round(fp / nullif(fp + tn, 0)::DOUBLE, 6) AS fpr, round(1000 * fp / nullif(fp + tn, 0)::DOUBLE, 6) AS alarms_per_1000 FROM c""",
)
def detection(spark, folder):
    rows = T.table(spark, folder, "labels").join(T.table(spark, folder, "documents").select("doc_id", "lang", "n_chars"), "doc_id")
    return evaluation.detection(rows, "lang", F.col("quality") == 0, F.col("n_chars") < 400)



@query(
    "a8_by_group",
    """SELECT source, lang, count(*) AS docs, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY GROUPING SETS ((source), (lang), ())""",
)
def by_group(spark, folder):
    docs = T.table(spark, folder, "documents").select("source", "lang", "n_chars")
    return docs.groupingSets([["source"], ["lang"], []], "source", "lang").agg(F.count("*").alias("docs"), F.sum("n_chars").alias("chars"))



@query(
    "w13_review_curve",
    """WITH r AS (SELECT row_number() OVER (ORDER BY n_chars DESC, doc_id) AS n, (quality = 0)::INT AS e FROM labels JOIN documents USING (doc_id)), c AS (SELECT n, sum(e) OVER (ORDER BY n) AS errors FROM r),
    t AS (SELECT coalesce(sum(e), 0) AS total FROM r), b(kind, budget) AS (VALUES ('items', 10), ('items', 25), ('items', 50), ('items', 100), ('false_alarms', 0), ('false_alarms', 1), ('false_alarms', 5), ('false_alarms', 10)),
    m AS (SELECT kind, budget, total, coalesce(max(n), 0) AS reviewed, coalesce(max(errors), 0) AS found FROM b CROSS JOIN t LEFT JOIN c ON (kind = 'items' AND n <= budget) OR (kind = 'false_alarms' AND n - errors <= budget) GROUP BY 1, 2, 3)
    SELECT kind, budget, reviewed, found::BIGINT AS found, round(found / nullif(reviewed, 0)::DOUBLE, 6) AS precision, round(found / nullif(total, 0)::DOUBLE, 6) AS recall FROM m""",
)
def review_curve(spark, folder):
    rows = T.table(spark, folder, "labels").join(T.table(spark, folder, "documents").select("doc_id", "n_chars"), "doc_id").withColumn("error", F.col("quality") == 0)
    return windows.review_curve(rows, "n_chars", "doc_id", "error", [10, 25, 50, 100], [0, 1, 5, 10])


@query(
    "w16_ranges",
    """SELECT o_custkey, o_orderkey AS start, coalesce(lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1, (SELECT max(o_orderkey) FROM orders)) AS stop FROM orders""",
)
def chapter_ranges(spark, folder):
    orders = T.table(spark, folder, "orders").select("o_custkey", F.col("o_orderkey").alias("start"))
    last = orders.agg(F.max("start")).first()[0]
    return windows.ranges(orders, "o_custkey", "start", F.lit(last))


@query(
    "w19_runs",
    """WITH e AS (SELECT user_id, event_id, ts, event_type, lag(event_type) OVER w AS p FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    r AS (SELECT user_id, event_type, sum(CASE WHEN p IS NULL OR p <> event_type THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run, event_id FROM e)
    SELECT user_id, event_type, count(*) AS n, min(event_id) AS first_id FROM r GROUP BY user_id, event_type, run HAVING count(*) >= 3""",
)
def runs(spark, folder):
    e = T.table(spark, folder, "events").select("user_id", "event_id", "ts", "event_type")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    marked = windows.islands(e.withColumn("new", F.col("event_type") != F.lag("event_type").over(w)), ["user_id"], ["ts", "event_id"], F.col("new"), "run")
    return marked.groupBy("user_id", "event_type", "run").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id")).where("n >= 3").drop("run")


@query(
    "a22_sessions",
    """WITH s AS (SELECT user_id, date_trunc('day', ts) AS d, count(*) AS n, count(*) FILTER (event_type = 'error') AS errors, (max(epoch_us(ts)) - min(epoch_us(ts))) / 60000000.0 AS minutes FROM events GROUP BY 1, 2)
    SELECT user_id, count(*) AS sessions, sum(errors)::BIGINT AS errors, median(n) AS median_events, round(sum(errors) / nullif(sum(minutes), 0), 6) AS errors_per_minute FROM s GROUP BY 1""",
)
def review_sessions(spark, folder):
    t = F.unix_micros(F.col("ts").cast("timestamp"))
    day = T.table(spark, folder, "events").groupBy("user_id", F.date_trunc("day", "ts").alias("d")).agg(
        F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("errors"), ((F.max(t) - F.min(t)) / 60000000.0).alias("minutes")
    )
    return day.groupBy("user_id").agg(
        F.count("*").alias("sessions"), F.sum("errors").alias("errors"), F.median("n").alias("median_events"), F.round(F.try_divide(F.sum("errors"), F.sum("minutes")), 6).alias("errors_per_minute")
    ).select("user_id", "sessions", F.col("errors"), "median_events", "errors_per_minute")





@query(
    "isbn_check",
    r"""WITH d AS (SELECT p_partkey, '978' || lpad(p_partkey::VARCHAR, 9, '0') AS b FROM part),
    s AS (SELECT p_partkey, b, list_sum(list_transform(range(1, 13), lambda i: substr(b, i, 1)::INT * (CASE WHEN i % 2 = 0 THEN 3 ELSE 1 END))) AS s,
    list_sum(list_transform(range(1, 10), lambda i: substr(b, i + 3, 1)::INT * (11 - i))) AS t FROM d)
    SELECT p_partkey, ((10 - s % 10) % 10)::INT AS isbn13, CASE WHEN (11 - t % 11) % 11 = 10 THEN 'X' ELSE ((11 - t % 11) % 11)::INT::VARCHAR END AS isbn10 FROM s""",
)
def isbn(spark, folder):
    body = F.lpad(F.col("p_partkey").cast("string"), 9, "0")
    return T.table(spark, folder, "part").select("p_partkey", X.isbn13_check(F.concat(F.lit("978"), body)).alias("isbn13"), X.isbn10_check(body).alias("isbn10"))



_STAR = {
    "rel_inner_join": "SELECT n_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1",
    "rel_left_join": "SELECT c_custkey, count(o_orderkey) AS orders FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1",
    "rel_right_join": "SELECT n_name, count(s_suppkey) AS suppliers FROM supplier RIGHT JOIN nation ON s_nationkey = n_nationkey GROUP BY 1",
    "rel_full_join": "SELECT coalesce(c_nationkey, s_nationkey) AS k, any_c, any_s FROM (SELECT c_nationkey, count(*) AS any_c FROM customer WHERE c_acctbal > 9000 GROUP BY 1) FULL JOIN (SELECT s_nationkey, count(*) AS any_s FROM supplier GROUP BY 1) ON c_nationkey = s_nationkey",
    "rel_semi_join": "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')",
    "rel_anti_join": "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)",
    "rel_range_join": "SELECT l_orderkey, l_linenumber, count(*) AS later FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND l_shipdate > o_orderdate GROUP BY 1, 2",
    "rel_union": "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier",
    "rel_intersect": "SELECT l_partkey AS k FROM lineitem INTERSECT SELECT p_partkey FROM part",
    "rel_except": "SELECT p_partkey AS k FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 45",
    "rel_cube": "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)",
    "rel_rollup": "SELECT r_name, n_name, count(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)",
    "rel_rank": "SELECT o_custkey, o_orderkey, rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS r, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS d FROM orders",
    "rel_frame": "SELECT o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS s FROM orders",
    "rel_topk": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
    "rel_distinct": "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem",
    "rel_revenue": "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_quantity), 6) AS avg_qty FROM lineitem GROUP BY 1, 2",
    "rel_case": "SELECT CASE WHEN o_totalprice > 200000 THEN 'large' WHEN o_totalprice > 50000 THEN 'middle' ELSE 'small' END AS size, count(*) AS n FROM orders GROUP BY 1",
}


def _star(sql: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        frames = {name: T.table(spark, folder, name) for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem") if name in sql}
        text = sql
        for name in frames:
            text = re.sub(rf"\b(FROM|JOIN) {name}\b", rf"\1 {{{name}}}", text)
        return spark.sql(text, **frames)

    return run


for _name, _sql in _STAR.items():
    query(_name, _sql)(_star(_sql))


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return T.table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@query(
    "st_windows",
    "SELECT date_trunc('day', ts)::TIMESTAMP AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
)
def st_windows(spark, folder):
    return feeds.windowed(_events(spark, folder)).withColumn("start", F.col("start").cast("timestamp_ntz"))


@query(
    "st_session",
    """WITH e AS (SELECT user_id, epoch_us(ts) AS t, lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events),
    r AS (SELECT user_id, t, sum(CASE WHEN p IS NULL OR t - p >= 1800000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY t) AS s FROM e)
    SELECT user_id, min(t) AS start_us, max(t) + 1800000000 AS stop_us, count(*) AS n FROM r GROUP BY user_id, s""",
)
def st_session(spark, folder):
    return feeds.sessions(_events(spark, folder)).select("user_id", F.unix_micros("start").alias("start_us"), F.unix_micros("stop").alias("stop_us"), "n")


@query(
    "st_dedupe",
    "SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS k FROM events) WHERE k = 1",
)
def st_dedupe(spark, folder):
    return feeds.deduplicated(_events(spark, folder), ["user_id", "event_type"]).select("event_id", "user_id", "event_type")


@query(
    "st_ledger",
    """WITH e AS (SELECT event_id, user_id, ts, event_type FROM events), w AS (SELECT event_id, user_id, max((ts, event_id, event_type)) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p,
    count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier FROM e)
    SELECT event_id, user_id, p[2] AS prior_id, p[3] AS prior_type, earlier FROM w""",
)
def st_ledger(spark, folder):
    return feeds.ledger(_events(spark, folder))


@query(
    "a13_quantiles",
    """SELECT event_type, median(value) AS med, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1""",
)
def quantiles(spark, folder):
    return T.table(spark, folder, "events").groupBy("event_type").agg(F.median("value").alias("med"), F.percentile("value", 0.25).alias("q1"), F.percentile("value", 0.75).alias("q3"))



@query(
    "a24_shares",
    "SELECT event_type, round(sum(value), 4) AS total, round(sum(value) / (SELECT sum(value) FROM events), 6) AS share FROM events GROUP BY 1",
)
def shares(spark, folder):
    sums = T.table(spark, folder, "events").groupBy("event_type").agg(F.sum("value").alias("t"))
    whole = F.sum("t").over(Window.partitionBy(F.lit(1)))  # one row a type
    return sums.select("event_type", F.round("t", 4).alias("total"), F.round(F.try_divide("t", whole), 6).alias("share"))


@query(
    "j19_sequences",
    """WITH s AS (SELECT DISTINCT l_orderkey, l_linenumber AS n FROM lineitem), k AS (SELECT l_orderkey, n, row_number() OVER (PARTITION BY l_orderkey ORDER BY n) AS k FROM s)
    SELECT l_orderkey, bool_and(n = k) AS complete, count(*) AS notes, min(CASE WHEN n <> k THEN k END) AS first_missing FROM k GROUP BY 1""",
)
def sequences(spark, folder):
    notes = T.table(spark, folder, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("n")).distinct()
    numbered = notes.withColumn("k", F.row_number().over(Window.partitionBy("l_orderkey").orderBy("n")))
    return numbered.groupBy("l_orderkey").agg(F.bool_and(F.col("n") == F.col("k")).alias("complete"), F.count("*").alias("notes"), F.min(F.when(F.col("n") != F.col("k"), F.col("k"))).alias("first_missing"))


@query(
    "k_ranked_per_group",
    """SELECT l_suppkey, l_orderkey, l_linenumber, k FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_quantity) AS k FROM lineitem) WHERE k <= 3""",
)
def ranked_per_group(spark, folder):
    order = Window.partitionBy("l_suppkey").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return T.table(spark, folder, "lineitem").withColumn("k", F.row_number().over(order)).where("k <= 3").select("l_suppkey", "l_orderkey", "l_linenumber", "k")


@query("s18_sampled_pages", "SELECT DISTINCT n AS page FROM (SELECT unnest([1, 2, 3]) AS n UNION ALL SELECT 1 + round_even(i * (m - 1) / 8.0, 0)::INT FROM range(9) t(i), (SELECT count(*) AS m FROM pages)) ")
def sampled_pages(spark, folder):
    n = T.table(spark, folder, "pages").count()
    places = [1, 2, 3, *[1 + round(i * (n - 1) / 8) for i in range(9)]]
    return spark.range(1).select(F.explode(F.array_distinct(F.array(*map(F.lit, places)))).alias("page"))



