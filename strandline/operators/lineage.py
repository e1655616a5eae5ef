"""Cutting lineage in loops, in the folder that the cluster names."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """df checkpointed: each loop round reads the round before, not its plan again.

    The folder is spark.checkpoint.dir; where it is missing, a local master gets a
    temporary one and any other an error.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="strandline-")
        context.setCheckpointDir(folder)
    return df.checkpoint()
