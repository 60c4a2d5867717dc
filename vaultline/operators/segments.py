"""A vault whose history is segmented, pruned, regrouped by calendar and committed batch by batch.

Layout: ``<root>/<table>/part=<name>`` holds the rows one write appended, hash
segmented (Spark buckets) on the columns the table's "already loaded" check
compares, so an hourly load joins the history without shuffling it: only the
batch's candidates move.  Rows carry ``batch_id``.

* **Commit.** ``<root>/_manifest/v=<n>`` lists the visible parts of all tables.
  Parts of a running load are seen by that load alone; ``commit`` writes the
  next manifest, one file, which appears whole or not at all.  A load that dies
  leaves the old state visible, and its parts are garbage (``garbage``,
  ``vacuum``).  One writer at a time; readers keep the version they opened.
* **Pruning.** A part's manifest row has the range of its first check column,
  and ``<root>/_filters`` a Bloom filter of its check keys: 64-bit words, four
  bits a key, about four keys a word.  ``History.matching`` leaves out parts
  that hold none of the candidates, so their files are not read.  Every segment
  has words of its own, so a task that reads a piece of a segment makes that
  piece's words, and nothing is shuffled; a key's bits are always in one row.
* **Regrouping.** ``fold`` rewrites the parts of one calendar bucket (day, then
  month, then year, seen from ``as_of``) into one part: large ones piece by
  piece, as their files lie, for these hold a segment each.  A rerun of a folded
  batch masks the batch's old rows there; the next fold drops them.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from datetime import date

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from vaultline.functions.calendar import calendar_bucket
from vaultline.functions.keys import NARROW, KeyKind
from vaultline.operators.store import BATCH_ID, Batch, _empty, observed, path_exists, schema_of

# The columns each table's "already loaded" check compares: its segmentation.
CHECK_KEYS: dict[str, tuple[str, ...]] = {
    "h_users": ("user_id",),
    "h_groups": ("group_id",),
    "h_dialogs": ("message_id",),
    "l_admins": ("hk_user_id", "hk_group_id"),
    "l_user_message": ("hk_user_id", "hk_message_id"),
    "l_groups_dialogs": ("hk_group_id", "hk_message_id"),
    "l_user_group_activity": ("hk_user_id", "hk_group_id"),
    "s_user_socdem": ("hk_user_id",),
    "s_user_chat_info": ("hk_user_id",),
    "s_group_name": ("hk_group_id",),
    "s_group_private_status": ("hk_group_id",),
    "s_admins": ("hk_l_admin_id",),
    "s_dialog_info": ("hk_message_id",),
    "s_auth_history": ("hk_l_user_group_activity",),
}

MANIFEST = ("table_name STRING, part STRING, batch_ids ARRAY<BIGINT>, masked ARRAY<BIGINT>, load_day DATE, "
            "n_rows BIGINT, low BIGINT, high BIGINT, words BIGINT")
_KEYS_PER_WORD = 4
_PROBE = 1000  # keys looked up first, and their range: a part that holds one of them needs no further look
_FOLDS = 4  # parts folded side by side
_LARGE_SEGMENT = 100_000  # rows; parts with more a segment are folded as their files lie


@dataclass(frozen=True)
class Part:
    """One manifest row: ``masked`` batches of ``batch_ids`` were replaced and are not read."""

    table_name: str
    part: str
    batch_ids: tuple[int, ...]
    masked: tuple[int, ...]
    load_day: date
    n_rows: int
    low: int | None
    high: int | None
    words: int  # of the Bloom filter, per segment; 0: none


def _word_and_mask(keys: list[str]) -> tuple[Column, Column]:
    """A key's hash (its low bits choose the word) and its four bits."""
    bits = F.xxhash64(F.lit("bits"), *keys)
    mask = F.lit(0).cast("long")
    for at in (0, 6, 12, 18):
        place = F.shiftright(bits, at).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return F.xxhash64(*keys), mask


@dataclass
class History:
    """The rows of earlier batches; ``matching`` reads only the parts that may hold a candidate."""

    vault: SegmentedVault
    name: str
    parts: list[Part]
    batch: Batch

    def rows(self, parts: list[Part] | None = None) -> DataFrame:
        return self.vault.segmented(self.name, self.parts if parts is None else parts, self.batch)

    def select(self, *cols) -> DataFrame:
        return self.rows().select(*cols)

    def dealt(self, candidates: DataFrame) -> DataFrame:
        """Candidates dealt as the history is: the check joins them where they are, and what is new is written there."""
        self.vault._dealt.add(self.name)
        return candidates.repartition(self.vault.segments, *CHECK_KEYS[self.name])

    def matching(self, asked: DataFrame, keys: list[str]) -> DataFrame:
        """The history without parts that hold none of the check keys ``asked`` for (the candidates', or more)."""
        check = list(CHECK_KEYS[self.name])
        if not set(check) <= set(keys):
            return self.rows()
        return self.rows(self.vault.parts_with(self.name, self.parts, asked.select(*check)))


@dataclass
class SegmentedVault:
    """Vault tables in segmented parts behind a manifest."""

    spark: SparkSession
    root: str
    segments: int = 64  # hash segments per table; fixed for the life of a vault
    prune: bool = True
    keys: KeyKind = NARROW  # fixed for the life of a vault
    materialized = True
    _committed: list[Part] | None = field(default=None, repr=False)
    _pending: list[Part] = field(default_factory=list, repr=False)
    _dealt: set[str] = field(default_factory=set, repr=False)  # tables whose rows come in their segments
    _lock: threading.Lock = field(default_factory=threading.Lock, repr=False)  # tables are written side by side

    # -- manifest ---------------------------------------------------------------------------

    def _manifests(self) -> DataFrame | None:
        path = f"{self.root.rstrip('/')}/_manifest"
        return self.spark.read.schema(f"{MANIFEST}, v BIGINT").parquet(path) if path_exists(self.spark, path) else None

    def version(self) -> int:
        """Number of the newest manifest; 0 before the first commit."""
        found = self._manifests()
        return (found.agg(F.max("v")).first()[0] or 0) if found is not None else 0

    def parts(self) -> list[Part]:
        """The committed parts, read once per instance and commit."""
        with self._lock:
            if self._committed is None:
                found, newest = self._manifests(), self.version()
                rows = found.where(F.col("v") == newest).drop("v").collect() if newest else []
                self._committed = [Part(r[0], r[1], tuple(r[2]), tuple(r[3]), *r[4:]) for r in rows if r["part"]]
            return self._committed

    def _publish(self, parts: list[Part]) -> int:
        rows = [(p.table_name, p.part, list(p.batch_ids), list(p.masked), p.load_day, p.n_rows, p.low, p.high, p.words)
                for p in parts]
        rows = rows or [(None, None, [], [], None, None, None, None, None)]  # an empty vault has a file, too
        at = self.version() + 1
        (self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("errorifexists")
         .parquet(f"{self.root.rstrip('/')}/_manifest/v={at}"))
        self._committed = list(parts)
        return at

    def commit(self, batch: Batch) -> int:
        """Make the batch's appends visible, all at once; its earlier rows go where a table was appended anew."""
        fresh = {p.table_name for p in self._pending if batch.batch_id in p.batch_ids}
        kept = []
        for p in self.parts():
            if p.table_name not in fresh or batch.batch_id not in p.batch_ids:
                kept.append(p)
            elif set(p.batch_ids) - set(p.masked) != {batch.batch_id}:
                kept.append(replace(p, masked=tuple(sorted({*p.masked, batch.batch_id}))))
        done = self._publish(kept + [p for p in self._pending if p.n_rows])
        self._pending = []
        return done

    # -- reading ----------------------------------------------------------------------------

    def _path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def _schema(self, name: str) -> StructType:
        return StructType([*schema_of(name, self.keys).fields, StructField(BATCH_ID, LongType(), True)])

    def visible(self, name: str) -> list[Part]:
        """The parts this instance reads: committed ones, and its own load's in place of that batch's."""
        own = [p for p in self._pending if p.table_name == name]
        redone = {b for p in own for b in p.batch_ids}
        out = []
        for p in self.parts():
            if p.table_name == name:
                masked = set(p.masked) | (redone & set(p.batch_ids))
                if set(p.batch_ids) - masked:
                    out.append(replace(p, masked=tuple(sorted(masked))))
        return out + [p for p in own if p.n_rows]

    @staticmethod
    def _unmasked(df: DataFrame, parts: list[Part], without: int | None = None) -> DataFrame:
        for p in parts:
            hidden = {*p.masked} | ({without} & {*p.batch_ids})
            if hidden:
                df = df.where(~((F.col("part") == p.part) & F.col(BATCH_ID).isin(*hidden)))
        return df

    def _plain(self, name: str, parts: list[Part], without: int | None = None) -> DataFrame:
        """Rows of ``parts`` read as files: a join may split what is hot in them."""
        if not parts:
            return _empty(self.spark, self._schema(name))
        schema = StructType([*self._schema(name).fields, *StructType.fromDDL("part STRING").fields])
        df = (self.spark.read.schema(schema).option("basePath", self._path(name))
              .parquet(*(f"{self._path(name)}/part={p.part}" for p in parts)))
        return self._unmasked(df, parts, without).drop("part")

    def segmented(self, name: str, parts: list[Part], batch: Batch | None = None) -> DataFrame:
        """Rows of ``parts``, without those of ``batch``, read as hash segments: a join on them needs no exchange."""
        fields = schema_of(name, self.keys).fieldNames()
        without = batch.batch_id if batch else None
        parts = [p for p in parts if set(p.batch_ids) - {*p.masked, without}]
        if not parts or name not in CHECK_KEYS:
            return self._plain(name, parts, without).select(*fields)
        table = f"vaultline_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self._schema(name).fields)
        self.spark.sql(
            f"CREATE TABLE {table} ({columns}, part STRING) USING parquet PARTITIONED BY (part) "
            f"CLUSTERED BY ({', '.join(CHECK_KEYS[name])}) INTO {self.segments} BUCKETS LOCATION '{self._path(name)}'")
        self.spark.sql(f"ALTER TABLE {table} ADD " + " ".join(
            f"PARTITION (part = '{p.part}') LOCATION '{self._path(name)}/part={p.part}'" for p in parts))
        df = self.spark.table(table).where(F.col("part").isin([p.part for p in parts]))
        return self._unmasked(df, parts, without).select(*fields)

    def empty(self, name: str) -> DataFrame:
        return _empty(self.spark, schema_of(name, self.keys))

    def table(self, name: str) -> DataFrame:
        return self._plain(name, self.visible(name)).select(*schema_of(name, self.keys).fieldNames())

    def existing(self, name: str, batch: Batch) -> History:
        return History(self, name, [p for p in self.visible(name) if set(p.batch_ids) - {*p.masked, batch.batch_id}], batch)

    def batch_rows(self, name: str, batch: Batch) -> DataFrame:
        parts = [p for p in self.visible(name) if batch.batch_id in p.batch_ids]
        return (self._plain(name, parts).where(F.col(BATCH_ID) == batch.batch_id)
                .select(*schema_of(name, self.keys).fieldNames()))

    # -- pruning ----------------------------------------------------------------------------

    def parts_with(self, name: str, parts: list[Part], keys: DataFrame) -> list[Part]:
        """The ``parts`` that may hold one of ``keys`` (the table's check columns)."""
        if not self.prune or not parts:
            return parts
        check = list(CHECK_KEYS[name])
        hashed, mask = _word_and_mask(check)

        def near(keys: DataFrame, among: list[Part]) -> list[Part]:
            """The parts whose range meets that of ``keys``; a part without one (wide keys) is near all of them."""
            if not among:
                return []
            low, high = keys.agg(F.min(check[0]), F.max(check[0])).first()
            return [] if low is None else [p for p in among if p.low is None or (p.low <= high and p.high >= low)]

        def hits(keys: DataFrame, among: list[Part], few: bool) -> set[str]:
            """The parts whose filter knows one of ``keys``; ``few`` keys go to the filters, which then stay put."""
            if not among:
                return set()
            sizes = F.array(*(F.lit(n).cast("long") for n in sorted({p.words for p in among})))
            asked = keys.select(self._segment(check).alias("segment"), hashed.alias("h"), mask.alias("mask"),
                                F.explode(sizes).alias("words"))
            asked = asked.select("words", self._word(F.col("segment"), F.col("h"), F.col("words")).alias("word"), "mask")
            filters = (self.spark.read.schema("words BIGINT, word BIGINT, bits BIGINT, part STRING")
                       .option("basePath", self._path(f"_filters/{name}"))
                       .parquet(*(f"{self._path(f'_filters/{name}')}/part={p.part}" for p in among)))
            found = (filters.join(F.broadcast(asked) if few else asked, ["words", "word"])
                     .where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
                     .select("part").distinct())  # at most one row per part
            return {r["part"] for r in found.collect()}

        # a few keys first: mostly they meet every part, and then the others are not looked at
        probe = keys.limit(_PROBE)
        met = {p.part for p in near(probe, parts)}
        hit = {p.part for p in parts if not p.words and p.part in met}
        hit |= hits(probe, [p for p in parts if p.words and p.part in met], few=True)
        left = near(keys, [p for p in parts if p.part not in hit])
        hit |= {p.part for p in left if not p.words} | hits(keys, [p for p in left if p.words], few=False)
        return [p for p in parts if p.part in hit]

    def _segment(self, keys) -> Column:
        """The segment Spark writes a row to."""
        return F.pmod(F.hash(*keys), F.lit(self.segments))

    @staticmethod
    def _word(segment: Column, hashed: Column, words: Column) -> Column:
        return segment * words + hashed.bitwiseAND(words - 1)

    def _write_filter(self, name: str, part: str, n_rows: int) -> int:
        """Store the Bloom filter of a written part; returns its number of words per segment."""
        words = 1 << max(1, (max(1, n_rows // (_KEYS_PER_WORD * self.segments)) - 1).bit_length())
        (self._filter_rows(name, part, words).write.mode("overwrite")
         .parquet(f"{self._path(f'_filters/{name}')}/part={part}"))
        return words

    def _filter_rows(self, name: str, part: str, words: int) -> DataFrame:
        """Words and bits of a written part; the tasks that read it make them, and a word of two tasks comes twice."""
        check, size = list(CHECK_KEYS[name]), F.lit(words).cast("long")
        hashed, mask = _word_and_mask(check)
        rows = self.spark.read.schema(self._schema(name)).parquet(f"{self._path(name)}/part={part}")

        def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """The bits of equal words put together; the words come in order."""
            for batch in batches:
                word, mask = (batch.column(n).to_numpy() for n in ("word", "mask"))
                if len(word):
                    first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
                    yield pa.RecordBatch.from_pydict({"word": word[first], "bits": np.bitwise_or.reduceat(mask, first)})

        return (rows.select(self._word(self._segment(check), hashed, size).alias("word"), mask.alias("mask"))
                .sortWithinPartitions("word").mapInArrow(merged, "word BIGINT, bits BIGINT")
                .select(size.alias("words"), "word", "bits"))

    # -- writing ----------------------------------------------------------------------------

    def _write(self, name: str, rows: DataFrame, part: str, dealt: bool = False) -> tuple[int, int | None, int | None]:
        """Rows (with batch_id) as one part, segmented; returns their count and the range of the first check key.

        ``dealt``: the rows come segment by segment already.
        """
        keys, target, obs = CHECK_KEYS.get(name), f"{self._path(name)}/part={part}", Observation()
        measures = [F.count(F.lit(1)).alias("rows")]
        if keys and isinstance(rows.schema[keys[0]].dataType, LongType):  # wide keys have no range worth keeping
            measures += [F.min(keys[0]).alias("low"), F.max(keys[0]).alias("high")]
        out = rows.observe(obs, *measures)
        if keys:
            table = f"vaultline_{uuid.uuid4().hex}"
            if not dealt:  # one segment a task; adaptive execution splits a large segment and joins small ones
                out = out.withColumn("_segment", self._segment(keys)).hint("rebalance", "_segment").drop("_segment")
            (out.write.mode("overwrite").format("parquet")
             .bucketBy(self.segments, *keys).sortBy(*keys).option("path", target).saveAsTable(table))
            self.spark.sql(f"DROP TABLE {table}")  # the catalog's entry; the files stay
        else:
            out.hint("rebalance").write.mode("overwrite").parquet(target)
        n = observed(obs, "rows")
        if n is None:  # an input found empty at run time reports nothing
            n = self.spark.read.schema(self._schema(name)).parquet(target).count()
        if not keys or not n:
            return n, None, None
        return n, obs.get.get("low"), obs.get.get("high")

    def append(self, name: str, rows: DataFrame, batch: Batch) -> int:
        """Write the batch's rows as a part that only this instance sees until ``commit``."""
        part = f"b{batch.batch_id}-{uuid.uuid4().hex[:12]}"
        out = rows.select(*schema_of(name, self.keys).fieldNames(), F.lit(batch.batch_id).cast("long").alias(BATCH_ID))
        # the rows of s_admins are joined once more after their check
        dealt = name in self._dealt and name != "s_admins"
        self._dealt.discard(name)
        n, low, high = self._write(name, out, part, dealt)
        words = self._write_filter(name, part, n) if self.prune and n and name in CHECK_KEYS else 0
        made = Part(name, part, (batch.batch_id,), (), date.fromisoformat(batch.load_dt[:10]), n, low, high, words)
        with self._lock:
            self._pending = [p for p in self._pending if p.table_name != name or p.batch_ids != (batch.batch_id,)] + [made]
        return n

    def clear(self, name: str, batch: Batch) -> int:
        """Make the batch's part of ``name`` empty (an earlier run may have written it)."""
        if any(batch.batch_id in p.batch_ids for p in self.visible(name)):
            return self.append(name, self.empty(name), batch)
        return 0

    # -- regrouping -------------------------------------------------------------------------

    def fold(self, as_of: str) -> dict[str, int]:
        """Rewrite the parts of every calendar bucket before the day ``as_of`` as one part each.

        Returns the number of parts left per table.  Masked rows are dropped on the way.
        """
        if self._pending:
            raise RuntimeError("a load is running: commit it first")
        parts = self.parts()
        days = sorted({p.load_day for p in parts if p.load_day < date.fromisoformat(as_of[:10])})
        if not days:
            return self._per_table(parts)
        buckets = {r["d"]: r["b"] for r in self.spark.createDataFrame([(d,) for d in days], "d DATE")
                   .select("d", calendar_bucket("d", as_of[:10]).alias("b")).collect()}
        groups: dict[tuple[str, date], list[Part]] = {}
        for p in parts:
            if p.load_day in buckets:
                groups.setdefault((p.table_name, buckets[p.load_day]), []).append(p)
        out = [p for p in parts if p.load_day not in buckets]

        def folded(name: str, bucket: date, members: list[Part]) -> list[Part]:
            if len(members) == 1 and not members[0].masked:
                return members
            part = f"d{bucket:%Y%m%d}-{uuid.uuid4().hex[:12]}"
            large = sum(p.n_rows for p in members) > _LARGE_SEGMENT * self.segments
            n, low, high = self._write(name, self._plain(name, members), part, dealt=large)
            words = self._write_filter(name, part, n) if self.prune and n and name in CHECK_KEYS else 0
            batches = sorted({b for p in members for b in set(p.batch_ids) - set(p.masked)})
            # the latest of its days, so that it joins the month, and later the year, it belongs to
            return [Part(name, part, tuple(batches), (), max(p.load_day for p in members), n, low, high, words)] if n else []

        # independent jobs, submitted together
        with ThreadPoolExecutor(max_workers=_FOLDS) as pool:
            for made in [pool.submit(folded, *group, members) for group, members in groups.items()]:
                out += made.result()
        self._publish(out)
        return self._per_table(out)

    @staticmethod
    def _per_table(parts: list[Part]) -> dict[str, int]:
        counts: dict[str, int] = {}
        for p in parts:
            counts[p.table_name] = counts.get(p.table_name, 0) + 1
        return counts

    def _folders(self, path: str) -> list[str]:
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        fs = target.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        return [s.getPath().toString() for s in fs.listStatus(target) if s.isDirectory()] if fs.exists(target) else []

    def garbage(self) -> list[str]:
        """Folders no reader of the newest manifest needs: parts of dead loads, folded parts, old manifests."""
        held = {(p.table_name, p.part) for p in [*self.parts(), *self._pending]}
        out = [f for f in self._folders(f"{self.root.rstrip('/')}/_manifest")
               if not f.endswith(f"/v={self.version()}")]
        tables = [f.rsplit("/", 1)[1] for f in self._folders(self.root.rstrip("/"))]
        for name in tables:
            if name.startswith("_") or name == "load_report":
                continue
            for path in (self._path(name), self._path(f"_filters/{name}")):
                out += [f for f in self._folders(path) if (name, f.rsplit("part=", 1)[-1]) not in held]
        return out

    def vacuum(self) -> int:
        """Delete the ``garbage``; only while no reader still holds an older manifest."""
        jvm, removed = self.spark._jvm, 0
        for path in self.garbage():
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)
            removed += 1
        return removed
