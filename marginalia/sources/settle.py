"""Lineage cut between rounds of an iteration."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def settled(df: DataFrame) -> DataFrame:
    """``df`` as a reliable checkpoint in the folder that
    ``spark.checkpoint.dir`` names; where it is unset, a local run gets a
    temporary one and a cluster an error."""
    spark = df.sparkSession
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and (not context.master.startswith("local") or context.master.startswith("local-cluster")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="marginalia-"))
    return df.checkpoint(eager=True)
