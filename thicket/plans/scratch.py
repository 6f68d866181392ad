"""Cuts in long plans."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile

from pyspark.sql import DataFrame


def hold(df: DataFrame) -> DataFrame:
    """`df`, computed and written to the folder in spark.checkpoint.dir: what several steps read is made once, survives lost executors, and later steps
    plan from a leaf instead of from its large expressions. Where that setting is absent a folder of our own takes its place, if all run in one process."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if not folder:
            folder = tempfile.mkdtemp(prefix="thicket-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return df.checkpoint()
