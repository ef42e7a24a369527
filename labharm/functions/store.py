"""Tables that a session writes into the folder which driver and executors share, and reads again."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []
_made: dict[tuple, DataFrame | str] = {}


def folder(spark: SparkSession, name: str = "files") -> str:
    """A new path below spark.checkpoint.dir; only where that is unset and all runs in this process (tests) below a temporary folder, which goes at exit."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="labharm-files-"))
            atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
        base = f"file://{_own[0]}"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
    """Writes df (in folders by some columns) and reads it again: lineage ends at files that outlive an executor."""
    path = folder(df.sparkSession, name)
    df.write.partitionBy(*by or []).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def once(spark: SparkSession, name: str, of: str, make: Callable[[], DataFrame | str], written: bool = False) -> DataFrame | str:
    """What make returns for a folder `of` of input tables, a table or a path; made and written once a session. written: the table comes from written ones already, at little cost."""
    key = (spark.sparkContext.applicationId, name, of)
    if key not in _made:
        made = make()
        _made[key] = made if written or isinstance(made, str) else cut(made, name)
    return _made[key]


def forget() -> None:
    """Has everything made anew when it is next asked for."""
    _made.clear()
