"""Cutting lineage so that a stage that several later stages read is computed once.

``checkpoint`` writes to the folder that ``spark.checkpoint.dir`` names, which all
executors share.  Only where a session names none (tests, a laptop) a folder under
the warehouse directory of the session is set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; set one only where none is configured, on a local master.

    Raises RuntimeError on a cluster without a configured folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not named and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from the written rows."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager)
