"""Session-level settings every job reads: the shared work folder and the size limits."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Bytes of partial sums the driver adds up itself. Above this the cluster adds them first.
DRIVER_SUM_BYTES = 32 * 1024 * 1024
# Bytes of model state (weights, centres, sums) a task holds in a pass; more takes more passes.
TASK_STATE_BYTES = 256 * 1024 * 1024
# Columns of a block of cross products.
BLOCK_COLUMNS = 512
# Bytes of mini-batch rows that one descent run may fetch; beyond it batches stay on the cluster.
BATCH_ROWS_BYTES = 32 * 1024 * 1024
# Models that a pass scores by a user's metric; more takes more passes.
SCORED_MODELS = 512
# Rows of the largest piece of a table, times passes, from which on spreading the table pays.
SPREAD_ROWS = 2_000_000
# Distinct values one categorical column may expand into.
MAX_CLASSES = 1000
# Distinct strata for which exact positions are tracked on the driver.
MAX_STRATA = 64


_local_root: str | None = None


def work_folder(spark: SparkSession) -> str:
    """A fresh folder path under the cluster's shared checkpoint folder.

    The folder named in ``spark.checkpoint.dir`` is used. Only a local session without that
    setting falls back to a temporary folder of its own.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        _local_root = root = _local_root or tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


@contextmanager
def limits(**values: int) -> Iterator[None]:
    """Other size limits for what runs inside, such as ``limits(TASK_STATE_BYTES=64 * 1024 * 1024)``.

    They decide how much work a pass takes on, never what comes out.
    """
    before = {name: globals()[name] for name in values}
    globals().update(values)
    try:
        yield
    finally:
        globals().update(before)
