"""Where vault tables live between loads.

``MemoryVault`` keeps every batch's new rows as lazy DataFrames (queries and
tests compose whole multi-batch loads as one plan); ``ParquetVault`` appends
each batch into its own ``<table>/batch_id=N`` directory and reads tables
back from storage, which also cuts the lineage between load steps.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from vaultline.functions.keys import NARROW, KeyKind
from vaultline.schemas import VAULT, VAULT_SEGMENT

BATCH_ID = "batch_id"

# Rows a loader could not place (unknown hub member, NULL business key).
QUARANTINE = StructType(
    [
        StructField("table_name", StringType(), True),
        StructField("reason", StringType(), True),
        StructField("record", StringType(), True),
    ]
)


@dataclass(frozen=True)
class Batch:
    """One load run: its id (orders batches), load timestamp and source tag."""

    batch_id: int
    load_dt: str  # 'YYYY-MM-DD HH:MM:SS', no time zone
    load_src: str = "s3"

    def load_columns(self) -> list[Column]:
        return [
            F.lit(self.load_dt).cast(TimestampNTZType()).alias("load_dt"),
            F.lit(self.load_src).alias("load_src"),
        ]


def observed(obs: Observation | None, name: str) -> int | None:
    """An observed count, or None when the metrics never arrived.

    Adaptive execution may replace a subtree it finds empty at runtime, and
    the observation inside it then reports nothing; callers fall back to
    counting (or to the slower path) in that case.
    """
    if obs is None:
        return None
    try:
        return int(obs.get[name])
    except Exception:  # noqa: BLE001 - the metrics row is missing or malformed
        return None


def schema_of(name: str, keys: KeyKind = NARROW) -> StructType:
    """Schema of a vault table, or of a quarantine table ``q_<table>``; surrogate keys are columns ``hk_*``."""
    if name in VAULT:
        return StructType([StructField(f.name, keys.type, f.nullable) if f.name.startswith("hk_") else f
                           for f in VAULT[name].fields])
    if name.startswith("q_") and name[2:] in VAULT:
        return QUARANTINE
    raise KeyError(name)


def _empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """An empty table the optimizer knows is empty (joins against it fold away)."""
    cols = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).select(*cols).where(F.lit(False))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, asked of its own file system (the default one where it names none)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(target)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


@dataclass
class MemoryVault:
    """Vault tables as lazy unions of per-batch DataFrames."""

    spark: SparkSession
    parts: dict[str, list[tuple[int, DataFrame]]] = field(default_factory=dict)
    keys: KeyKind = NARROW
    materialized = False  # appends only record plans
    _empties: dict = field(default_factory=dict, repr=False)

    def _select(self, name: str, keep) -> DataFrame:
        frames = [df for b, df in self.parts.get(name, []) if keep(b)]
        return _union(frames) if frames else self.empty(name)

    def table(self, name: str) -> DataFrame:
        return self._select(name, lambda b: True)

    def existing(self, name: str, batch: Batch) -> DataFrame:
        return self._select(name, lambda b: b != batch.batch_id)

    def batch_rows(self, name: str, batch: Batch) -> DataFrame:
        return self._select(name, lambda b: b == batch.batch_id)

    def clear(self, name: str, batch: Batch) -> None:
        self.append(name, self.empty(name), batch)
        return None

    def empty(self, name: str) -> DataFrame:
        key = f"empty:{name}"
        if key not in self._empties:
            self._empties[key] = _empty(self.spark, schema_of(name, self.keys))
        return self._empties[key]

    def append(self, name: str, rows: DataFrame, batch: Batch) -> int | None:
        kept = [(b, df) for b, df in self.parts.get(name, []) if b != batch.batch_id]
        self.parts[name] = kept + [(batch.batch_id, rows.select(*schema_of(name, self.keys).fieldNames()))]
        return None


@dataclass
class ParquetVault:
    """Vault tables stored as parquet, one directory per batch.

    A batch owns ``<root>/<table>/batch_id=N``.  Appending statically
    overwrites only that directory, so rerunning batch N (after a failure, or
    to replay it) replaces exactly its own rows and never touches older
    batches; ``existing`` excludes batch N, so a rerun compares against the
    vault as it was before N.  One writer per table at a time.
    """

    spark: SparkSession
    root: str
    files_per_batch: int | None = None
    # Keep each table's file listing until this instance appends to it.  Only
    # safe while no other writer touches the vault (one run, a finished vault).
    cache_reads: bool = False
    keys: KeyKind = NARROW  # fixed for the life of a vault
    materialized = True  # every append is a write job
    _frames: dict = field(default_factory=dict, repr=False)

    def empty(self, name: str) -> DataFrame:
        return _empty(self.spark, schema_of(name, self.keys))

    def _path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def _all(self, name: str) -> DataFrame:
        """The stored table with its batch column (file listing cached until an append)."""
        cached = self._frames.get(name)
        if cached is not None:
            return cached
        schema = StructType(list(schema_of(name, self.keys).fields) + [StructField(BATCH_ID, LongType(), True)])
        if not path_exists(self.spark, self._path(name)):
            return _empty(self.spark, schema)
        df = self.spark.read.schema(schema).parquet(self._path(name))
        if self.cache_reads:
            self._frames[name] = df
        return df

    def table(self, name: str) -> DataFrame:
        return self._all(name).select(*schema_of(name, self.keys).fieldNames())

    def existing(self, name: str, batch: Batch) -> DataFrame:
        df = self._all(name).where(F.col(BATCH_ID) != F.lit(batch.batch_id))
        return df.select(*schema_of(name, self.keys).fieldNames())

    def batch_rows(self, name: str, batch: Batch) -> DataFrame:
        df = self._all(name).where(F.col(BATCH_ID) == F.lit(batch.batch_id))
        return df.select(*schema_of(name, self.keys).fieldNames())

    def clear(self, name: str, batch: Batch) -> int:
        """Make the batch's part of ``name`` empty (a previous attempt may have written it)."""
        if not path_exists(self.spark, f"{self._path(name)}/{BATCH_ID}={batch.batch_id}"):
            return 0  # nothing was ever written for this batch: nothing to clear
        return self.append(name, self.empty(name), batch)

    def append(self, name: str, rows: DataFrame, batch: Batch) -> int:
        """Write the batch's rows (replacing a previous attempt) and return their count."""
        obs = Observation()
        out = rows.select(*schema_of(name, self.keys).fieldNames()).observe(obs, F.count(F.lit(1)).alias("rows"))
        segment = VAULT_SEGMENT.get(name)
        if self.files_per_batch:
            out = (out.repartition(self.files_per_batch, segment) if segment
                   else out.repartition(self.files_per_batch))
        else:
            # a load's rows come out of its last exchange, whose partitions adaptive execution
            # has sized: they are written as they lie; only what was set aside is gathered
            out = out if segment else out.hint("rebalance")
        if segment:
            out = out.sortWithinPartitions(segment)
        target = f"{self._path(name)}/{BATCH_ID}={batch.batch_id}"
        self._frames.pop(name, None)
        out.write.mode("overwrite").parquet(target)
        self._frames.pop(name, None)
        n = observed(obs, "rows")
        if n is None:  # the written files' row counts live in their footers
            n = self.spark.read.schema(schema_of(name, self.keys)).parquet(target).count()
        return n
