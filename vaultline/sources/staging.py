"""Staging tables: CSV scan with rejects, declared types and lengths, full refresh.

Landed files are comma separated with one header line; columns are taken by
position and the header names are ignored.  Rows that do not parse (too few or
too many fields, text in a number, a bad timestamp, an unknown boolean) are
kept aside with their raw line and a reason; good rows continue.

The parsed frame is written once, partitioned by ``is_rejected`` (and a
calendar bucket of the table's date column).  Splitting *after* that write
matters: the CSV reader prunes columns, and a scan that only asks for the good
columns never sees the corrupt-record column and lets bad rows through.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, StringType, StructField, StructType

from vaultline.functions.calendar import calendar_bucket
from vaultline.functions.text import truncate_utf8_bytes
from vaultline.operators.store import observed
from vaultline.schemas import BYTE_LIMITS, STAGING, STAGING_DATE_COLUMN, STAGING_SORT

REJECTED_LINE = "_rejected_line"
REJECT_REASON = "reject_reason"
IS_REJECTED = "is_rejected"
DATE_BUCKET = "date_bucket"


def conformed_columns(table: str) -> list[Column]:
    """Declared column order and types, text cut to its declared byte length."""
    limits = BYTE_LIMITS.get(table, {})
    cols: list[Column] = []
    for field in STAGING[table].fields:
        if field.name in limits:  # declared text: already a string on every path
            c = truncate_utf8_bytes(field.name, limits[field.name])
        else:
            c = F.col(field.name).cast(field.dataType)
        cols.append(c.alias(field.name))
    return cols


def conform(df: DataFrame, table: str) -> DataFrame:
    return df.select(*conformed_columns(table))


def _csv_schema(table: str) -> StructType:
    """Parse schema: booleans arrive as text (validated afterwards), plus the raw-line column."""
    fields = [
        StructField(f.name, StringType() if isinstance(f.dataType, BooleanType) else f.dataType, True)
        for f in STAGING[table].fields
    ]
    return StructType(fields + [StructField(REJECTED_LINE, StringType(), True)])


def read_csv(spark: SparkSession, path: str | list[str], table: str,
             dialect: str = "default") -> DataFrame:
    """Parse landed CSV files of ``table``; every row comes back, bad ones flagged.

    ``dialect="reference"`` declares no quote character, so a quoted comma
    splits the field exactly like the warehouse bulk loader; the default honours
    double quotes and keeps such values whole.
    """
    reader = (
        spark.read.schema(_csv_schema(table))
        .option("header", True)
        .option("enforceSchema", True)
        .option("sep", ",")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", REJECTED_LINE)
    )
    if dialect == "reference":
        reader = reader.option("quote", "")
    elif dialect != "default":
        raise ValueError(f"unknown CSV dialect {dialect!r}")
    parsed = reader.csv(path)

    reason = F.when(F.col(REJECTED_LINE).isNotNull(), F.lit("malformed row"))
    typed: list[Column] = []
    for f in STAGING[table].fields:
        if isinstance(f.dataType, BooleanType):
            raw = F.col(f.name)
            value = raw.try_cast("boolean")
            reason = reason.when(raw.isNotNull() & value.isNull(), F.lit(f"{f.name}: not a boolean"))
            typed.append(value.alias(f.name))
        else:
            typed.append(F.col(f.name))
    # the parser keeps the raw line only for rows it could not type; rebuild it otherwise
    raw_line = F.coalesce(
        F.col(REJECTED_LINE),
        F.concat_ws(",", *[F.coalesce(F.col(f.name).cast("string"), F.lit("")) for f in STAGING[table].fields]),
    )
    return parsed.select(
        *typed,
        reason.alias(REJECT_REASON),
        raw_line.alias("raw_line"),
        F.input_file_name().alias("source_file"),
    )


@dataclass
class StagingReport:
    table: str
    rows_loaded: int
    rows_rejected: int


def refresh_staging(parsed: DataFrame, table: str, staging_root: str, as_of: str,
                    joined: bool = False) -> StagingReport:
    """Full refresh of one staging table (truncate + load) in one write job.

    Good rows are conformed (types, byte lengths); rejects keep their raw line.
    The table is partitioned by ``is_rejected`` and, for dated tables, by the
    calendar bucket of its date column seen from ``as_of``.  The row counts come
    from an observation on the write itself, not from a second pass.
    ``joined``: the rows come out of joins, whose partitions adaptive execution
    has sized, and are not shuffled again; each of these then has a file per bucket.
    """
    rejected = F.col(REJECT_REASON).isNotNull()
    conformed = zip(STAGING[table].fields, conformed_columns(table))
    out = parsed.select(
        *[F.when(~rejected, c).alias(f.name) for f, c in conformed],
        F.col(REJECT_REASON),
        F.when(rejected, F.col("raw_line")).alias("raw_line"),
        F.col("source_file"),
        rejected.alias(IS_REJECTED),
    )
    partitions = [IS_REJECTED]
    date_col = STAGING_DATE_COLUMN[table]
    if date_col:
        out = out.withColumn(DATE_BUCKET, calendar_bucket(date_col, as_of))
        partitions.append(DATE_BUCKET)
    obs = Observation()
    out = out.observe(
        obs,
        F.count(F.when(~F.col(IS_REJECTED), 1)).alias("loaded"),
        F.count(F.when(F.col(IS_REJECTED), 1)).alias("rejected"),
    )
    (
        (out if joined else out.hint("rebalance", *partitions))
        .sortWithinPartitions(*partitions, STAGING_SORT[table])  # row groups then hold ranges a reader can skip
        .write.mode("overwrite")
        .partitionBy(*partitions)
        .parquet(f"{staging_root.rstrip('/')}/{table}")
    )
    loaded, rejected_rows = observed(obs, "loaded"), observed(obs, "rejected")
    if loaded is None or rejected_rows is None:
        # an input found empty at run time reports no metrics: count the written table
        spark = parsed.sparkSession
        written = spark.read.schema(_staged_schema(table)).parquet(f"{staging_root.rstrip('/')}/{table}")
        loaded = written.where(~F.col(IS_REJECTED)).count()
        rejected_rows = written.where(F.col(IS_REJECTED)).count()
    return StagingReport(table, loaded, rejected_rows)


def _staged_schema(table: str) -> StructType:
    extra = [
        StructField(REJECT_REASON, StringType(), True),
        StructField("raw_line", StringType(), True),
        StructField("source_file", StringType(), True),
        StructField(IS_REJECTED, BooleanType(), True),
    ]
    if STAGING_DATE_COLUMN[table]:
        extra.append(StructField(DATE_BUCKET, DateType(), True))
    return StructType(list(STAGING[table].fields) + extra)


def read_staging(spark: SparkSession, staging_root: str, table: str) -> DataFrame:
    """Good rows of a refreshed staging table (rejects pruned by partition)."""
    df = spark.read.schema(_staged_schema(table)).parquet(f"{staging_root.rstrip('/')}/{table}")
    return df.where(~F.col(IS_REJECTED)).select(*[f.name for f in STAGING[table].fields])


def read_rejects(spark: SparkSession, staging_root: str, table: str) -> DataFrame:
    """The reject table: raw line, reason and source file of every bad row."""
    df = spark.read.schema(_staged_schema(table)).parquet(f"{staging_root.rstrip('/')}/{table}")
    return df.where(F.col(IS_REJECTED)).select("raw_line", REJECT_REASON, "source_file")
