"""Helpers shared by the operators: reading tables, stored intermediate tables, word patterns."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from vaultline.session import checkpoint_dir

# Fixed value: a word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def work_dir(spark: SparkSession) -> str:
    """A fresh folder under ``spark.checkpoint.dir``; a local one only where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix="vaultline-llm-"))
    return f"{base.rstrip('/')}/vaultline-llm/{uuid.uuid4().hex}"


_written: ContextVar[list[str] | None] = ContextVar("_written", default=None)  # by ``stored``, inside ``settled``


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: lineage ends there."""
    spark = df.sparkSession
    path = work_dir(spark)
    if (written := _written.get()) is not None:
        written.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """``build()`` stored; the tables that ``stored`` wrote while it was built are deleted then, or if it fails.

    Nothing else may read those tables later.  The result itself belongs to the enclosing ``settled``, if any.
    """
    temporary: list[str] = []
    outer = _written.set(temporary)
    try:
        result = build()
        _written.reset(outer)
        outer = None
        return stored(result)
    finally:
        if outer is not None:
            _written.reset(outer)
        for path in temporary:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def fresh(name: str, columns: list[str]) -> str:
    """``name``, lengthened until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(columns: list[str]) -> list[str]:
    """Column names as expressions: dots and blanks in them are part of the name."""
    return ["`" + c.replace("`", "``") + "`" for c in columns]
