"""Streaming forms of the decision feed; each has a batch twin of the same
transformation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def stream(spark: SparkSession, path: str, schema) -> DataFrame:
    """A Parquet folder or file pattern as a stream."""
    return spark.readStream.schema(schema).parquet(path)


def windowed(events: DataFrame, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Events and their value per window and type; streams drop what is later
    than ``late``."""
    base = events.withWatermark("ts", late) if events.isStreaming else events
    return base.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(
        F.col("window.start").alias("start"), "event_type", "n", "total"
    )


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Events per user and session; a pause of ``gap`` ends one."""
    base = events.withWatermark("ts", late) if events.isStreaming else events
    return base.groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n")).select(
        "user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("stop"), "n"
    )


def deduplicated(events: DataFrame, keys: list[str], late: str = "1 hour") -> DataFrame:
    """The first event of each key: what a replay sends again is dropped."""
    if events.isStreaming:
        return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)
    order = Window.partitionBy(*keys).orderBy("ts", "event_id")
    return events.withColumn("_k", F.row_number().over(order)).where("_k = 1").drop("_k")


def ledger(events: DataFrame) -> DataFrame:
    """Each decision with the last one of the same user strictly before it."""
    order = Window.partitionBy("user_id").orderBy(F.unix_micros("ts")).rangeBetween(Window.unboundedPreceding, -1)
    return events.select(
        "event_id",
        "user_id",
        F.max(F.struct("ts", "event_id", "event_type")).over(order).alias("p"),
        F.count("*").over(order).alias("earlier"),
    ).select("event_id", "user_id", F.col("p.event_id").alias("prior_id"), F.col("p.event_type").alias("prior_type"), "earlier")


def ledger_stream(events: DataFrame, late: str = "1 hour", keep_days: int = 30) -> DataFrame:
    """The ledger as a stateful stream: per user the last decision and how
    many came before; events of a batch are taken in order of time.  A user's
    state goes when the watermark is ``keep_days`` past the last event, so state
    does not grow with all users there ever were."""
    import pandas as pd
    from pyspark.sql.streaming.state import GroupStateTimeout

    def run(key, frames, state):
        if state.hasTimedOut:
            state.remove()
            return
        time_, id_, kind, seen = state.get if state.exists else (None, None, None, 0)
        frame = pd.concat(list(frames)).sort_values(["ts", "event_id"])
        out, n, last = [], seen, (time_, id_, kind)
        for ts, rows in frame.groupby("ts", sort=True):
            out += [(event.event_id, key[0], last[1], last[2], n) for event in rows.itertuples()]
            n += len(rows)
            last = (int(pd.Timestamp(ts).value // 1000), int(rows.event_id.iloc[-1]), rows.event_type.iloc[-1])
        state.update((*last, n))
        state.setTimeoutTimestamp(max(last[0] // 1000 + keep_days * 86_400_000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=["event_id", "user_id", "prior_id", "prior_type", "earlier"])

    return events.withWatermark("ts", late).groupBy("user_id").applyInPandasWithState(
        run,
        "event_id long, user_id long, prior_id long, prior_type string, earlier long",
        "ts long, event_id long, event_type string, n long",
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )


def accepted(decisions: DataFrame) -> DataFrame:
    """``decisions`` with ``status``: ``duplicate-id`` for an id seen before,
    ``conflict`` where a span has different decisions, ``duplicate-span`` for
    the same one again, else ``accepted``.

    ``decisions(id, page, row_id, start, stop, decision, value, ts)``."""
    ids = Window.partitionBy("id").orderBy("ts")
    span = ["page", "row_id", "start", "stop"]
    rows = decisions.withColumn("_i", F.row_number().over(ids))
    first = rows.where("_i = 1").withColumn("_k", F.row_number().over(Window.partitionBy(*span).orderBy("ts", "id")))
    same = Window.partitionBy(*span)
    first = first.withColumn("_same", (F.min(F.struct("decision", "value")).over(same) == F.max(F.struct("decision", "value")).over(same)))
    status = F.when(~F.col("_same"), "conflict").when(F.col("_k") > 1, "duplicate-span").otherwise("accepted")
    again = rows.where("_i > 1").withColumn("status", F.lit("duplicate-id"))
    return first.withColumn("status", status).drop("_i", "_k", "_same").unionByName(again.drop("_i"))


def annotated(items: DataFrame, records: DataFrame, near: DataFrame) -> DataFrame:
    """``word, suggestions, kept, review_priority``: items with what feedback on
    strictly earlier pages says.

    Confirmed corrections within two edits are suggested, the best five by
    (distance, form); a word that was kept before goes down to priority 3,
    unless its witnesses disagree.  ``items(word, first_page, peer_conflict,
    review_priority)``, ``records(form, page, decision)``, ``near(word, term,
    distance)`` from :func:`lexicon.near_terms`."""
    forms = records.select(F.lower("form").alias("term"), "page", "decision", "form")
    errors = near.join(forms.where("decision = 'ocr-error'"), "term").join(items.select("word", "first_page"), "word").where("page < first_page and term <> word")
    best = errors.groupBy("word", "term", "distance").agg(F.array_sort(F.collect_set("form")).alias("forms"))
    ranked = best.withColumn("_k", F.row_number().over(Window.partitionBy("word").orderBy("distance", "term"))).where("_k <= 5")
    lists = ranked.groupBy("word").agg(F.transform(F.array_sort(F.collect_list(F.struct("_k", "term"))), lambda x: x["term"]).alias("suggestions"))
    kept = forms.where("decision = 'keep'").join(items.select(F.col("word").alias("term"), "first_page"), "term").where("page < first_page").groupBy(F.col("term").alias("word")).agg(F.count("*").alias("_kept"))
    rows = items.join(lists, "word", "left").join(kept, "word", "left")
    lowered = F.col("_kept").isNotNull() & ~F.col("peer_conflict")
    return rows.select("word", F.coalesce("suggestions", F.array().cast("array<string>")).alias("suggestions"), F.coalesce("_kept", F.lit(0)).alias("kept"), F.when(lowered, F.greatest(F.lit(3), "review_priority")).otherwise(F.col("review_priority")).alias("review_priority"))


def contexts_stream(pairs: DataFrame, limit: int, late: str = "1 hour") -> DataFrame:
    """How many earlier pairs of a document fit into a context of ``limit``
    characters, as a stateful stream: state is the sizes that still fit, starts
    anew with each document and goes a day after its last pair.

    ``pairs(document, seq, size, ts)``; a document's pairs come in order."""
    import pandas as pd
    from pyspark.sql.streaming.state import GroupStateTimeout

    def run(key, frames, state):
        if state.hasTimedOut:
            state.remove()
            return
        held = list(state.get[0]) if state.exists else []
        frame, out = pd.concat(list(frames)).sort_values("seq"), []
        for row in frame.itertuples():
            fits, used = 0, 0
            for size in reversed(held):
                used += size
                if used > limit:
                    break
                fits += 1
            out.append((key[0], int(row.seq), fits))
            held = [*held[len(held) - fits :], int(row.size)]
        state.update((held,))
        state.setTimeoutTimestamp(max(int(pd.Timestamp(frame.ts.max()).value // 10**6) + 86_400_000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=["document", "seq", "context_rows"])

    return pairs.withWatermark("ts", late).groupBy("document").applyInPandasWithState(run, "document long, seq long, context_rows long", "sizes array<long>", "append", GroupStateTimeout.EventTimeTimeout)
