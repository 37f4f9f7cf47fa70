"""URL filters by pattern rules indexed on their rarest literal token, in
DataFrame operations only.

A rule is a regular expression over ``host + path`` with the literal tokens
any match must hold.  Each rule is filed under the token that the fewest URLs
hold; the tokens of a URL fetch the rules filed under them, and only those
expressions run on it.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.llm.native_text import lower_ascii

ALLOW, BLOCK = "allow", "block"
#: Rules up to this number are broadcast: some 200 bytes each, 10 MB at most.
BROADCAST_RULES = 50_000
_TOKEN_GAP = r"[^0-9A-Za-z]+"


@dataclass(frozen=True)
class Rule:
    """``name`` is shown for host rules, the longest of which wins; rules
    without a name are patterns and decide where no host rule fits."""

    verdict: str
    regex: str
    tokens: tuple[str, ...]
    name: str | None = None


def host_rule(verdict: str, rule: str) -> Rule:
    """``host/path``: the host and its subdomains, paths that start so."""
    host, slash, path = rule.partition("/")
    path = slash + path
    tokens = re.split(_TOKEN_GAP, host + path)
    if path and path[-1].isalnum():
        tokens.pop()  # a path may go on in the middle of a token
    return Rule(verdict, r"^(?:[^/]*\.)?" + re.escape(host) + re.escape(path), tuple(t for t in tokens if t), rule)


def word_pattern(verdict: str, *words: str) -> Rule:
    """URLs that hold the words, in this order, joined by hyphens."""
    return Rule(verdict, rf"(?:^|[^0-9A-Za-z]){'-'.join(map(re.escape, words))}(?:[^0-9A-Za-z]|$)", words)


#: The contract's rules on hosts and paths.
HOST_RULES = [
    host_rule(ALLOW, "com/"),
    host_rule(BLOCK, "example.com/en/"),
    host_rule(ALLOW, "www.example.com/en/"),
    host_rule(BLOCK, "net/es/"),
    host_rule(BLOCK, "net/fr/"),
]
#: What no host rule judges: names of gambling, adult and malicious sites.
PATTERNS = [
    word_pattern(BLOCK, "casino"),
    word_pattern(BLOCK, "poker"),
    word_pattern(BLOCK, "free", "bets"),
    word_pattern(BLOCK, "slot", "machine"),
    word_pattern(BLOCK, "adult"),
    word_pattern(BLOCK, "xxx"),
    word_pattern(BLOCK, "porn"),
    word_pattern(BLOCK, "warez"),
    word_pattern(BLOCK, "phishing"),
    Rule(BLOCK, r"(?:^|[./-])malware(?:[./-]|$)", ("malware",)),
]


def host(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for a null or a text without ``://``."""
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1))


def path(url: Column) -> Column:
    """From the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def rule_table(raw: DataFrame) -> DataFrame:
    """Rules for :func:`judge` from a table ``verdict, kind, rule``.

    ``kind`` is ``host`` (``host/path``, its subdomains, paths that start so) or
    ``words`` (words of a URL joined by hyphens); rows without a letter or digit
    have no token and are left out.  Repeated rules are one."""
    host_, path_ = F.regexp_extract("rule", "^([^/]*)(.*)$", 1), F.regexp_extract("rule", "^([^/]*)(.*)$", 2)
    quoted = lambda c: F.concat(F.lit(r"\Q"), F.replace(c, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    is_host = F.col("kind") == "host"
    of_host = F.concat(F.lit(r"^(?:[^/]*\.)?"), quoted(host_), quoted(path_))
    of_words = F.concat(F.lit(r"(?:^|[^0-9A-Za-z])"), quoted(F.col("rule")), F.lit(r"(?:[^0-9A-Za-z]|$)"))
    tokens = F.filter(F.split("rule", _TOKEN_GAP), lambda t: t != "")
    # a path may go on in the middle of a token
    open_end = is_host & (path_ != "") & F.col("rule").rlike("[0-9A-Za-z]$")
    whole = F.when(open_end, F.slice(tokens, 1, F.greatest(F.size(tokens) - 1, F.lit(0)))).otherwise(tokens)
    cut = raw.select("verdict", F.when(is_host, F.col("rule")).alias("name"), F.when(is_host, of_host).otherwise(of_words).alias("regex"), F.array_distinct(whole).alias("tokens"))
    return cut.distinct().where("size(tokens) > 0").select(F.xxhash64("verdict", "regex").alias("id"), "name", "verdict", "regex", "tokens")


def _table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    text = json.dumps([{"id": i, "name": r.name, "verdict": r.verdict, "regex": r.regex, "tokens": sorted(set(r.tokens))} for i, r in enumerate(rules)])
    kind = "array<struct<id: bigint, name: string, verdict: string, regex: string, tokens: array<string>>>"
    return spark.range(1).select(F.explode(F.from_json(F.lit(text), kind)).alias("r")).select("r.*")


def judge(pages: DataFrame, rules: list[Rule] | DataFrame | None = None, *, url: str = "url", key: str = "page_id", default: str = ALLOW) -> DataFrame:
    """``key, host, path, rule, verdict, n_patterns`` per row.

    The longest host rule that fits gives rule and verdict; where none fits,
    ``rule`` is null and a fitting pattern gives the verdict (block before
    allow), else ``default``; of host rules of one length the last in order of
    name and verdict.  ``rules`` is a list or a table of :func:`rule_table`, of
    any size.  Null and malformed URLs have an empty host and path; null keys
    and repeated rows are returned as they come; very long URLs are read whole;
    other columns are never read; an empty table gives no rows.
    """
    spark = pages.sparkSession
    rules = HOST_RULES + PATTERNS if rules is None else rules
    if isinstance(rules, list):
        if untokened := [r.regex for r in rules if not r.tokens]:
            raise ValueError(f"rules need a literal token: {untokened[:3]}")
        table, size = _table(spark, rules), len(rules)
    else:
        table, size = rules, rules.count()
    small = F.broadcast if size <= BROADCAST_RULES else (lambda df: df)
    cut = pages.select(F.col(key).alias("key"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    tokens = cut.select("key", "host", "path", F.array_distinct(F.split(F.concat("host", "path"), _TOKEN_GAP)).alias("tokens"))
    wanted = table.select("id", F.explode("tokens").alias("token"))
    seen = tokens.select(F.explode("tokens").alias("token")).join(small(wanted.select("token").distinct()), "token", "left_semi")
    rarity = seen.groupBy("token").agg(F.count("*").alias("n"))
    filed = (
        wanted.join(rarity, "token", "left")
        .groupBy("id")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("least"))
        .where("least.n > 0")  # else no URL can match
        .select("id", F.col("least.token").alias("token"))
        .join(table.select("id", "name", "verdict", "regex"), "id")
    )
    # the null token stands for the row itself
    fetched = tokens.select("key", "host", "path", F.explode(F.concat(F.array(F.lit(None).cast("string")), F.col("tokens"))).alias("token")).join(
        small(filed), "token", "left"
    )
    tried = fetched.where("token is null or id is not null").withColumn("fits", F.expr("id is not null and rlike(concat(host, path), regex)"))
    found = tried.groupBy("key", "host", "path").agg(
        F.count(F.when(F.col("token").isNull(), 1)).alias("copies"),
        F.max(F.when(F.col("fits") & F.col("name").isNotNull(), F.struct(F.length("name").alias("n"), "name", "verdict"))).alias("rule"),
        F.max(F.when(F.col("fits") & F.col("name").isNull(), F.col("verdict"))).alias("pattern"),
        F.count_distinct(F.when(F.col("fits") & F.col("name").isNull(), F.col("id"))).alias("n_patterns"),
    )
    return found.select(
        F.col("key").alias(key),
        "host",
        "path",
        F.col("rule.name").alias("rule"),
        F.coalesce("rule.verdict", "pattern", F.lit(default)).alias("verdict"),
        "n_patterns",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
    ).drop("copy")
