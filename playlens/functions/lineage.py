"""Cut lineage with a written table in the shared folder; let go of what a cut lineage leaves on the disks."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from playlens.session import ensure_checkpoint_dir


def kept(df: DataFrame) -> DataFrame:
    """``df`` computed once, written under ``spark.checkpoint.dir`` and read back.

    Unlike ``checkpoint()``, which computes a frame a second time for its files, this writes as it computes,
    and later reads prune columns. The rows survive lost executors. The files stay until the folder, which is
    the cluster's scratch space, is cleared.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


CLEAN_SECONDS = 15


@contextmanager
def shuffles_cleaned(spark: SparkSession, seconds: float = CLEAN_SECONDS) -> Iterator[None]:
    """Meanwhile, has the driver look every few seconds for shuffles and cached blocks that nothing refers to.

    Spark deletes their files once the driver's JVM has collected the objects, which may be hours later
    (``spark.cleaner.periodicGC.interval``, 30 minutes by default and fixed when the session starts).
    """
    over = threading.Event()

    def clean() -> None:
        while not over.wait(seconds):
            spark.sparkContext._jvm.System.gc()

    cleaner = threading.Thread(target=clean, daemon=True)
    cleaner.start()
    try:
        yield
    finally:
        over.set()
        cleaner.join()
