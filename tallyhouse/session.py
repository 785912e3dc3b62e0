"""Session facts the operators need: the shared work folder, sizes, shuffle width."""

from __future__ import annotations

import re
import tempfile
from functools import cache

from pyspark.sql import DataFrame, SparkSession

_UNITS = {"": 1, "b": 1, "k": 2**10, "m": 2**20, "g": 2**30, "t": 2**40}
_COMPRESSION = 4


@cache
def _local_scratch(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="tallyhouse-")


def work_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder is used, but only in local mode: on a
    cluster a machine-local folder would be lost with its machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        return _local_scratch(spark.conf.get("spark.app.id"))
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def _bytes(text: str) -> int:
    number, unit = re.fullmatch(r"(-?\d+)\s*([bkmgt]?)b?", text.strip().lower()).groups()
    return int(number) * _UNITS[unit]


def fits_broadcast(df: DataFrame) -> bool:
    """True when a side is surely small enough to copy to every executor.

    Catalyst's estimate is checked against the session's broadcast limit, without a job. Over
    files the estimate is their compressed size, so rows are taken to need several times that.
    An unknown size counts as too large.
    """
    limit = _bytes(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    try:
        estimate = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    except (AttributeError, TypeError):
        return False
    return estimate * _COMPRESSION <= limit


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
