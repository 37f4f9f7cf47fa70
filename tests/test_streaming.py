"""Streams give what their batch twins give."""

import random
from datetime import datetime, timedelta

from marginalia.streaming import feeds


def events(spark, path):
    r = random.Random(6)
    start = datetime(2024, 1, 1)
    data = [(i, start + timedelta(minutes=7 * i + r.randint(0, 3)), r.randint(1, 5), r.choice(["keep", "edit", "error"]), float(i % 9)) for i in range(400)]
    spark.createDataFrame(data, "event_id long, ts timestamp, user_id long, event_type string, value double").coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def drained(df, name, mode):
    query = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return sorted(map(tuple, df.sparkSession.table(name).collect()), key=str)


def test_twins(spark, tmp_path):
    path = str(tmp_path / "events")
    batch = events(spark, path)
    live = feeds.stream(spark, path, batch.schema)
    assert drained(feeds.windowed(live), "w", "complete") == sorted(map(tuple, feeds.windowed(batch).collect()), key=str)
    assert drained(feeds.ledger_stream(live), "l", "append") == sorted(map(tuple, feeds.ledger(batch).collect()), key=str)
    keys = {(r.user_id, r.event_type) for r in batch.collect()}
    assert {(x[2], x[3]) for x in drained(feeds.deduplicated(live, ["user_id", "event_type"]), "d", "append")} == keys
    # the last sessions stay open until the watermark passes them
    whole = set(map(tuple, feeds.sessions(batch).collect()))
    assert set(drained(feeds.sessions(live), "s", "append")) <= whole
