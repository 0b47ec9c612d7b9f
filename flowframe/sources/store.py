"""Results that several plans read, kept where driver and executors both reach them."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def kept(df: DataFrame) -> DataFrame:
    """``df`` computed once, in the folder that spark.checkpoint.dir names; a lost executor loses nothing of it.

    Only a local session may go without that folder and gets a temporary one.
    """
    sc = df.sparkSession.sparkContext
    if not sc.getConf().get("spark.checkpoint.dir") and sc._jsc.sc().getCheckpointDir().isEmpty():
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="flowframe-"))
    return df.checkpoint()
