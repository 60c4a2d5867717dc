"""Audits of one batch: its rows alone are read, and checked against what earlier audits kept.

``<root>/<kind>/batch_id=N`` holds, per audited batch, three small tables:

* ``keys``: each hub and link key the batch appended, with its business key
  (hubs) and its number of rows, hash segmented on the key;
* ``findings``: the keys at fault, as changes: a key that became a duplicate,
  a surrogate key that came to stand for two business keys, a reference without
  its parent, and, as a negative number, a reference whose parent came with
  this batch;
* ``counts``: the changes of the checked and the violating rows of every constraint.

``totals`` sums the counts; it equals ``audits`` over the whole vault (a test
compares them).  A batch's keys are looked up in the kept ones, which are joined
as they are segmented: only the batch's keys and references, counted per key
first, are shuffled, and a key's references come in one row, a column for each
foreign key.  ``counts`` is written last and its folder makes a batch's
audit visible.  Auditing a batch again replaces its audit; as with the loads,
the later batches then have to be audited again.  One writer at a time.

Defined results: NULL keys and references are not checked (NOT NULL is its own
constraint); a batch without rows has counts of zero; before the first audit
``totals`` and ``violations`` are empty.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vaultline.functions.keys import NARROW, KeyKind
from vaultline.operators.audits import VAULT_FOREIGN_KEYS, VAULT_KEYS
from vaultline.operators.store import BATCH_ID, Batch, _empty, path_exists
from vaultline.plans.model import HUBS
from vaultline.schemas import VAULT_NOT_NULL

CHECK = ["table_name", "constraint_name", "column_name"]
COUNTS = "table_name STRING, constraint_name STRING, column_name STRING, n_checked BIGINT, n_violations BIGINT"
_KEY = ["key_value", "owner"]  # owner: the table whose key it is

# The foreign keys that refer to each table; a key's references are counted in one column for each.
_REFERRERS: dict[str, list[tuple[str, str]]] = {}
for _child, _column, _parent, _ in VAULT_FOREIGN_KEYS:
    _REFERRERS.setdefault(_parent, []).append((_child, _column))
_COUNTED = [f"n{at}" for at in range(max(map(len, _REFERRERS.values())))]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


@dataclass
class AuditLog:
    """What was found in each batch of a vault."""

    spark: SparkSession
    root: str
    segments: int = 64  # hash segments of the kept keys; fixed for the life of a log
    keys: KeyKind = NARROW

    def _schema(self, kind: str) -> str:
        key = self.keys.type.simpleString()
        return {"keys": f"owner STRING, key_value {key}, member BIGINT, n BIGINT",
                "findings": "table_name STRING, constraint_name STRING, column_name STRING, owner STRING, "
                            f"key_value {key}, n_violations BIGINT, n_repeats BIGINT"}[kind]

    def _path(self, kind: str, batch_id: int | None = None) -> str:
        return f"{self.root.rstrip('/')}/{kind}" + ("" if batch_id is None else f"/{BATCH_ID}={batch_id}")

    # -- reading ----------------------------------------------------------------------------

    def _counts(self) -> DataFrame:
        schema, path = f"{COUNTS}, {BATCH_ID} BIGINT", self._path("counts")
        return (self.spark.read.schema(schema).parquet(path) if path_exists(self.spark, path)
                else self.spark.createDataFrame([], schema))

    def batches(self) -> list[int]:
        """The audited batches."""
        return sorted(r[0] for r in self._counts().select(BATCH_ID).distinct().collect())

    def _kept(self, kind: str, batches: list[int]) -> DataFrame:
        """``keys`` or ``findings`` of ``batches``, in their segments: a join on the key needs no exchange."""
        if not batches:
            return _empty(self.spark, StructType.fromDDL(self._schema(kind)))
        name = f"vaultline_{uuid.uuid4().hex}"
        self.spark.sql(
            f"CREATE TABLE {name} ({self._schema(kind)}, {BATCH_ID} BIGINT) USING parquet PARTITIONED BY ({BATCH_ID}) "
            f"CLUSTERED BY ({', '.join(_KEY)}) INTO {self.segments} BUCKETS LOCATION '{self._path(kind)}'")
        self.spark.sql(f"ALTER TABLE {name} ADD " + " ".join(
            f"PARTITION ({BATCH_ID} = {b}) LOCATION '{self._path(kind, b)}'" for b in batches))
        return self.spark.table(name).where(F.col(BATCH_ID).isin(batches)).drop(BATCH_ID)

    def totals(self) -> DataFrame:
        """Checked and violating rows of every constraint of the vault, over all audited batches."""
        return self._counts().groupBy(*CHECK).agg(
            F.sum("n_checked").alias("n_checked"), F.sum("n_violations").alias("n_violations"))

    def violations(self) -> DataFrame:
        """The keys that are at fault now, with the number of violations of each."""
        return (self._kept("findings", self.batches()).groupBy(*CHECK, "key_value")
                .agg(F.sum("n_violations").alias("n_violations")).where("n_violations > 0"))

    # -- one batch --------------------------------------------------------------------------

    def audit(self, batch: Batch, rows: Callable[[str], DataFrame]) -> None:
        """Check the batch; ``rows(table)`` are the rows it appended to a hub, link or satellite."""
        earlier = [b for b in self.batches() if b < batch.batch_id]
        self._write("keys", self._own_keys(rows), batch, dealt=True)
        own = self._kept("keys", [batch.batch_id])
        self._write("findings", self._findings(own, self._references(rows), earlier), batch)
        found = self.spark.read.schema(self._schema("findings")).parquet(self._path("findings", batch.batch_id))
        self._write_counts(own, found, rows, batch)

    def _write(self, kind: str, rows: DataFrame, batch: Batch, dealt: bool = False) -> None:
        """``dealt``: the rows come segment by segment already."""
        name = f"vaultline_{uuid.uuid4().hex}"
        ((rows if dealt else rows.repartition(self.segments, *_KEY)).write.mode("overwrite").format("parquet")
         .bucketBy(self.segments, *_KEY).sortBy(*_KEY).option("path", self._path(kind, batch.batch_id)).saveAsTable(name))
        self.spark.sql(f"DROP TABLE {name}")  # the catalog's entry; the files stay

    def _own_keys(self, rows: Callable[[str], DataFrame]) -> DataFrame:
        """The batch's keys, dealt by segment once and counted there."""
        def of(table: str, key: str) -> DataFrame:
            member = F.col(HUBS[table].key_name) if table in HUBS else F.lit(None)
            return rows(table).select(F.lit(table).alias("owner"), F.col(key).alias("key_value"),
                                      member.cast("long").alias("member"))

        return (_union([of(t, k) for t, k in VAULT_KEYS.items()]).where("key_value IS NOT NULL")
                .repartition(self.segments, *_KEY)
                .groupBy("owner", "key_value", "member").agg(F.count(F.lit(1)).alias("n")))

    @staticmethod
    def _references(rows: Callable[[str], DataFrame]) -> DataFrame:
        """The batch's references per key and constraint: what a third of the rows refer to is one row a task."""
        def of(child: str, column: str, parent: str) -> DataFrame:
            at = _REFERRERS[parent].index((child, column))
            counted = (F.lit(1 if n == at else None).cast("long").alias(c) for n, c in enumerate(_COUNTED))
            return rows(child).select(F.col(column).alias("key_value"), F.lit(parent).alias("owner"), *counted)

        return (_union([of(child, column, parent) for child, column, parent, _ in VAULT_FOREIGN_KEYS])
                .where("key_value IS NOT NULL").groupBy(*_KEY).agg(*(F.sum(c).alias(c) for c in _COUNTED)))

    def _findings(self, own: DataFrame, references: DataFrame, earlier: list[int]) -> DataFrame:
        """Changes the batch's ``own`` keys (dealt by segment) and its references make."""
        # a row per key, dealt as the kept ones are, so that these stay where they are
        asked = (_union([own.select(*_KEY, "member", "n"), references]).repartition(self.segments, *_KEY)
                 .groupBy(*_KEY).agg(F.sum("n").alias("new"), F.min("member").alias("low"), F.max("member").alias("high"),
                                     *(F.sum(c).alias(c) for c in _COUNTED)))
        # every row has one of these: naming them all keeps the columns alike, and so the rows are shuffled once
        told = asked.where(F.coalesce("new", "low", "high", *_COUNTED).isNotNull())
        before = (self._kept("keys", earlier).join(told, _KEY, "left_semi")
                  .groupBy(*_KEY).agg(F.sum("n").alias("old"), F.min("member").alias("old_low"),
                                      F.max("member").alias("old_high")))
        at = F.create_map(*chain.from_iterable(
            (F.lit("|".join((parent, *referrer))), F.lit(n))
            for parent, referrers in _REFERRERS.items() for n, referrer in enumerate(referrers)))[
                F.concat_ws("|", "owner", "table_name", "column_name")]
        open_ = (self._kept("findings", earlier).where(F.startswith("constraint_name", F.lit("foreign_key:")))
                 .join(own.select(*_KEY), _KEY, "left_semi").withColumn("at", at)
                 .groupBy(*_KEY).agg(*(F.sum(F.when(F.col("at") == n, F.col("n_violations"))).alias(f"open_{c}")
                                       for n, c in enumerate(_COUNTED))))
        per_key = told.join(before, _KEY, "left").join(open_, _KEY, "left")
        zero = F.lit(0).cast("long")
        new, old = (F.coalesce(c, zero) for c in ("new", "old"))

        def became(now, was):
            return F.coalesce(now, F.lit(False)).cast("long") - F.coalesce(was, F.lit(False)).cast("long")

        shared = F.least("low", "old_low") < F.greatest("high", "old_high")
        measures = {
            "duplicate": became(old + new > 1, old > 1),
            "repeats": F.when(new > 0, new - (old == 0).cast("long")).otherwise(zero),
            "collision": became(shared, F.col("old_low") < F.col("old_high")),
            # without a parent, its references are at fault; one that came with this batch takes back what was open
            **{c: F.when(old + new == 0, F.coalesce(c, zero)).otherwise(-F.greatest(F.col(f"open_{c}"), zero))
               for c in _COUNTED}}
        faulty = per_key.select(*_KEY, *(m.alias(c) for c, m in measures.items())).where(
            reduce(lambda a, b: a | b, [F.col(c) != 0 for c in measures]))  # few: only theirs are spelled out

        def of_owner(names: dict[str, str]):
            return F.create_map(*chain.from_iterable((F.lit(t), F.lit(v)) for t, v in names.items()))[F.col("owner")]

        def finding(table, kind, column, violations: str, repeats=zero):
            return F.struct(table.alias("table_name"), kind.alias("constraint_name"), column.alias("column_name"),
                            F.col(violations).alias("n_violations"), repeats.alias("n_repeats"))

        found = [finding(F.col("owner"), F.lit("primary_key"), of_owner(VAULT_KEYS), "duplicate", F.col("repeats")),
                 finding(F.col("owner"), F.lit("hash_collision"), of_owner(VAULT_KEYS), "collision")]
        for n, c in enumerate(_COUNTED):
            referrers = {parent: of[n] for parent, of in _REFERRERS.items() if n < len(of)}
            found.append(finding(of_owner({p: child for p, (child, _) in referrers.items()}),
                                 F.concat(F.lit("foreign_key:"), "owner"),
                                 of_owner({p: column for p, (_, column) in referrers.items()}), c))
        return (faulty.select(*_KEY, F.inline(F.array(*found))).where("n_violations <> 0 OR n_repeats <> 0")
                .select(*CHECK, *reversed(_KEY), "n_violations", "n_repeats"))

    @staticmethod
    def _row_counts(table: str, df: DataFrame) -> DataFrame:
        """What rows alone tell: NULLs, ages, and how many references there are; one scan of the table."""
        def count(constraint: str, column: str, checked, violations=F.lit(0)):
            return F.struct(F.lit(table).alias("table_name"), F.lit(constraint).alias("constraint_name"),
                            F.lit(column).alias("column_name"), checked.cast("long").alias("n_checked"),
                            violations.cast("long").alias("n_violations"))

        counts = [count("not_null", c, F.count(F.lit(1)), F.count_if(F.col(c).isNull())) for c in VAULT_NOT_NULL[table]]
        counts += [count(f"foreign_key:{parent}", fk, F.count(fk))
                   for child, fk, parent, _ in VAULT_FOREIGN_KEYS if child == table]
        if table == "s_user_socdem":
            counts.append(count("check:age>=0", "age", F.count("age"), F.count_if(F.col("age") < 0)))
        return df.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))

    def _write_counts(self, own: DataFrame, found: DataFrame, rows: Callable[[str], DataFrame], batch: Batch) -> None:
        def named(df: DataFrame, table, constraint: str, column) -> DataFrame:
            return df.select(table.alias("table_name"), F.lit(constraint).alias("constraint_name"),
                             column.alias("column_name"), "n_checked", "n_violations")

        column = F.create_map(*chain.from_iterable((F.lit(t), F.lit(k)) for t, k in VAULT_KEYS.items()))[F.col("owner")]
        none = F.lit(0).cast("long").alias("n_violations")
        keys = own.groupBy("owner").agg(F.sum("n").alias("n_checked")).withColumn("n_violations", none)
        # a surrogate key is checked once, however many rows have it
        repeats = found.where(F.col("table_name").isin(list(HUBS)) & (F.col("constraint_name") == "primary_key")).groupBy(
            F.col("table_name").alias("owner")).agg((-F.sum("n_repeats")).alias("n_checked")).withColumn("n_violations", none)
        of_hubs = F.col("owner").isin(list(HUBS))
        parts = [named(keys, F.col("owner"), "primary_key", column),
                 *(named(df.where(of_hubs), F.col("owner"), "hash_collision", column) for df in (keys, repeats)),
                 found.select(*CHECK, F.lit(0).cast("long").alias("n_checked"), "n_violations")]
        parts += [self._row_counts(table, rows(table)) for table in VAULT_NOT_NULL]
        every = [(t, "primary_key", k, 0, 0) for t, k in VAULT_KEYS.items()]
        every += [(t, "hash_collision", spec.key, 0, 0) for t, spec in HUBS.items()]
        parts.append(self.spark.createDataFrame(every, COUNTS))
        (_union(parts).groupBy(*CHECK).agg(F.sum("n_checked").alias("n_checked"), F.sum("n_violations").alias("n_violations"))
         .coalesce(1).write.mode("overwrite").parquet(self._path("counts", batch.batch_id)))
