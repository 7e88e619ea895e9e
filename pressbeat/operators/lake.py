"""A table of Parquet files that keeps its versions.

A commit writes only the rows it adds or changes, below ``data/snapshot_id=N/<partition>=…``, and then
one line to the commit log. A version is read as the added rows that no later commit changed, plus the
newest form of the changed ones: the changes, not the table, are what gets shuffled.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressbeat.sources.files import gathered
from pressbeat.storage import materialize

CHANGE = "_change"
SNAPSHOT = "snapshot_id"
LOG_SCHEMA = (
    "snapshot_id bigint, parent_id bigint, committed_at timestamp, operation string, columns string, summary map<string, string>"
)


class VersionedTable:
    """``key`` columns identify a row; ``partition`` is derived from row columns that updates never change."""

    def __init__(self, spark: SparkSession, root: str, key: Sequence[str], partition: tuple[str, Column], fixed: Sequence[str] = ()):
        self.spark, self.root, self.key = spark, root.rstrip("/"), list(key)
        self.partition_name, self.partition_value = partition
        self.fixed = {*key, *fixed}

    @cached_property
    def data_path(self) -> str:
        return f"{self.root}/data"

    @cached_property
    def log_path(self) -> str:
        return f"{self.root}/log"

    # ---- the commit log

    def log(self) -> DataFrame:
        """One row per commit: id, parent, time, operation, summary counts."""
        return self.spark.read.schema(LOG_SCHEMA).parquet(self.log_path)

    def create(self, schema: T.StructType, committed_at: str) -> None:
        self._log(0, None, committed_at, "create", schema, {})

    def _log(self, number, parent, committed_at, operation, schema, summary) -> None:
        row = self.spark.createDataFrame(
            [(number, parent, operation, schema.json(), {k: str(v) for k, v in summary.items()})],
            "snapshot_id bigint, parent_id bigint, operation string, columns string, summary map<string, string>",
        ).withColumn("committed_at", F.lit(committed_at).cast("timestamp"))
        row.select(*T.StructType.fromDDL(LOG_SCHEMA).fieldNames()).coalesce(1).write.mode("append").parquet(self.log_path)

    def _state(self, as_of: int | None = None) -> tuple[int, int, T.StructType, bool]:
        """(version, version it starts from, columns, whether any row was changed since) in one small read."""
        log = self.log() if as_of is None else self.log().filter(F.col(SNAPSHOT) <= as_of)
        compacted = F.when(F.col("operation") == "compact", F.col(SNAPSHOT))
        changed = F.when(F.col("operation").isin("update", "merge"), F.col(SNAPSHOT))
        row = log.agg(
            F.max(SNAPSHOT).alias("version"), F.coalesce(F.max(compacted), F.lit(0)).alias("base"),
            F.max_by("columns", SNAPSHOT).alias("columns"), F.coalesce(F.max(changed), F.lit(0)).alias("changed"),
        ).first()
        if row["version"] is None:
            raise ValueError("no such version")
        return row["version"], row["base"], T.StructType.fromJson(json.loads(row["columns"])), row["changed"] > row["base"]

    def version_at(self, time: str) -> int:
        found = self.log().filter(F.col("committed_at") <= F.lit(time).cast("timestamp")).agg(F.max(SNAPSHOT)).first()[0]
        if found is None:
            raise ValueError(f"no version at {time}")
        return found

    def snapshots(self) -> DataFrame:
        """Commits with their parents and the records they added and replaced."""
        counts = [F.coalesce(F.try_element_at("summary", F.lit(k)).try_cast("bigint"), F.lit(0).cast("bigint")).alias(n)
                  for k, n in (("added-records", "added"), ("deleted-records", "deleted"))]
        return self.log().select(SNAPSHOT, "parent_id", "committed_at", "operation", *counts)

    # ---- reading

    def _stored(self, schema: T.StructType, low: int, high: int) -> DataFrame:
        extra = [T.StructField(CHANGE, T.StringType()), T.StructField(SNAPSHOT, T.LongType()), T.StructField(self.partition_name, T.StringType())]
        full = T.StructType([*schema.fields, *extra])
        stored = self.spark.read.schema(full).option("basePath", self.data_path).parquet(self.data_path)
        return stored.filter(F.col(SNAPSHOT).between(low, high))

    def _has_rows(self) -> bool:
        """Whether anything was ever appended; columns can be added to an empty table."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.data_path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def read(self, as_of: int | None = None, where: Column | None = None, partitions: Sequence[str] | None = None) -> DataFrame:
        """Rows of a version. ``partitions`` limits the scan; ``where`` is applied to the rows of the version."""
        version, base, schema, changed = self._state(as_of)
        if version == 0 or not self._has_rows():
            return self.spark.createDataFrame([], schema)
        stored = self._stored(schema, base, version)
        if partitions is not None:
            stored = stored.filter(F.col(self.partition_name).isin(*partitions))
        names = schema.fieldNames()
        if not changed:
            rows = stored
        else:
            added = stored.filter(F.col(CHANGE) == "insert")
            updates = stored.filter(F.col(CHANGE) == "update")
            rest = [c for c in names if c not in self.key]
            newest = updates.groupBy(*self.key).agg(
                F.max_by(F.struct(*rest), SNAPSHOT).alias("_row"), F.max(SNAPSHOT).alias("_at")
            )
            later = newest.select(*[F.col(k).alias(f"_k_{k}") for k in self.key], "_at")
            replaced = F.col("_at") > F.col(SNAPSHOT)
            for k in self.key:
                replaced = replaced & (F.col(k) == F.col(f"_k_{k}"))
            kept = added.join(later, replaced, "left_anti").select(*names)
            rows = kept.unionByName(newest.select(*self.key, "_row.*").select(*names))
        rows = rows.select(*names)
        return rows.filter(where) if where is not None else rows

    def files(self, as_of: int | None = None) -> DataFrame:
        """Data files of a version with record counts and sizes."""
        version, base, schema, _changed = self._state(as_of)
        stored = self._stored(schema, base, version)
        return stored.groupBy(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size")).agg(
            F.count(F.lit(1)).alias("record_count")
        )

    # ---- writing

    def _commit(self, rows: DataFrame | None, operation: str, committed_at: str, schema: T.StructType | None = None) -> int:
        version, _base, current, _changed = self._state()
        number, schema = version + 1, schema or current
        summary = {}
        if rows is not None:
            path = f"{self.data_path}/{SNAPSHOT}={number}"
            placed = rows.withColumn(self.partition_name, self.partition_value)
            # overwrite: a commit that died before its log line left files under this number
            gathered(placed, [self.partition_name]).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
                self.partition_name
            ).parquet(path)
            written = self.spark.read.schema(f"{CHANGE} string").parquet(path)
            counted = written.agg(F.count_if(F.col(CHANGE) == "insert").alias("i"), F.count_if(F.col(CHANGE) == "update").alias("u")).first()
            summary = {"added-records": counted["i"] + counted["u"], "deleted-records": counted["u"]}
        self._log(number, version, committed_at, operation, schema, summary)
        return number

    def append(self, rows: DataFrame, committed_at: str) -> int:
        """Adds rows whose keys are new to the table; missing columns become NULL."""
        schema = self._state()[2]
        return self._commit(self._fitted(rows, schema).withColumn(CHANGE, F.lit("insert")), "append", committed_at)

    def _fitted(self, rows: DataFrame, schema: T.StructType) -> DataFrame:
        return rows.select(
            *[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
        )

    def _check_settable(self, names) -> None:
        blocked = self.fixed.intersection(names)
        if blocked:
            raise ValueError(f"updates may not change {sorted(blocked)}")

    def update_where(self, condition: Column, sets: Mapping[str, Column], committed_at: str) -> int:
        self._check_settable(sets)
        changed = self.read(where=condition)
        schema = changed.schema
        updated = self._fitted(changed.withColumns(dict(sets)), schema)
        return self._commit(updated.withColumn(CHANGE, F.lit("update")), "update", committed_at)

    def merge(self, source: DataFrame, sets: Mapping[str, Column], inserts: Mapping[str, Column], committed_at: str) -> int:
        """Matched rows take ``sets``, unmatched source rows are added with ``inserts``.

        Expressions name target columns plainly and source columns as ``source.<name>``. Several source
        rows for one key are an error. The source is written first, so that its true size decides the joins; the table is
        reduced to the source's keys, and its other rows are not shuffled while these keys can be broadcast.
        """
        self._check_settable(sets)
        target, source = self.read(), materialize(source, "merge-source")
        repeated = source.groupBy(*self.key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1)
        if repeated.count():
            raise ValueError("several source rows have the same key")
        packed = source.select(*self.key, F.struct(*source.columns).alias("source"))
        present = target.join(source.select(*self.key), self.key, "left_semi").withColumn("_present", F.lit(True))
        joined = packed.join(present, self.key, "left")
        columns = []
        for field in target.schema.fields:
            old = F.col(field.name)
            new = inserts.get(field.name, F.col(field.name) if field.name in self.key else F.lit(None))
            chosen = F.when(F.col("_present"), sets.get(field.name, old)).otherwise(new)
            columns.append(chosen.cast(field.dataType).alias(field.name))
        change = F.when(F.col("_present"), "update").otherwise("insert").alias(CHANGE)
        return self._commit(joined.select(*columns, change), "merge", committed_at)

    def add_column(self, name: str, kind: str, committed_at: str, after: str | None = None) -> int:
        """A new column, NULL in the rows already stored; no data is rewritten."""
        schema = self._state()[2]
        field = T.StructField(name, T.StructType.fromDDL(f"c {kind}")[0].dataType)
        place = schema.fieldNames().index(after) + 1 if after else len(schema)
        fields = list(schema.fields)
        fields.insert(place, field)
        return self._commit(None, "add-column", committed_at, T.StructType(fields))

    def compact(self, committed_at: str) -> int:
        """Writes the current rows as a new starting point; later reads need no earlier commit."""
        return self._commit(self.read().withColumn(CHANGE, F.lit("insert")), "compact", committed_at)

    # ---- comparing and retiring versions

    def diff(self, before: int, after: int) -> DataFrame:
        """Rows added or changed between two versions, found from the commits in between.

        The stored rows of both versions meet the keys of these commits and each other by one shuffle; only rows of these keys go further, and a few
        keys are broadcast, so that other rows are not shuffled.
        """
        _version, low, schema, _changed = self._state(before)
        start = self._state(after)[1]
        names = schema.fieldNames()
        rest = [n for n in names if n not in self.key]
        at, update = F.col(SNAPSHOT), F.col(CHANGE) == "update"
        touched = self._stored(schema, before + 1, after).select(*self.key).distinct()
        stored = self._stored(schema, min(low, start), after).select(*names, CHANGE, SNAPSHOT).join(touched, self.key, "left_semi")
        of_key = Window.partitionBy(*self.key)
        by_commit = of_key.orderBy(SNAPSHOT, CHANGE)
        # of a commit's changes to one key one is read
        again = F.coalesce((F.lag(SNAPSHOT).over(by_commit) == at) & (F.lag(CHANGE).over(by_commit) == F.col(CHANGE)), F.lit(False))

        def newest(first: int, last: int) -> Column:
            return F.max(F.when(update & at.between(first, last), at)).over(of_key)

        def inside(first: int, last: int, changed: str) -> Column:
            is_newest = F.when(update, (at == F.col(changed)) & ~F.col("_again")).otherwise(F.col(changed).isNull() | (F.col(changed) <= at))
            return at.between(first, last) & is_newest

        placed = stored.withColumn("_again", again).withColumns({"_before": newest(low, before), "_after": newest(start, after)})
        old = placed.filter(inside(low, before, "_before")).select(*self.key, F.struct(*rest).alias("old_row"), F.xxhash64(*rest).alias("old_hash"))
        new = placed.filter(inside(start, after, "_after")).select(*self.key, F.struct(*rest).alias("new_row"), F.xxhash64(*rest).alias("new_hash"))
        joined = old.join(new, self.key, "full")
        same = (F.col("old_hash") == F.col("new_hash")) & F.col("old_row").eqNullSafe(F.col("new_row"))
        change = F.when(F.col("old_row").isNull(), "added").when(F.col("new_row").isNull(), "removed").when(~same, "changed")
        return joined.select(*self.key, change.alias("change"), "old_row", "new_row").filter(F.col("change").isNotNull())


def expired(snapshots: DataFrame, older_than: str, keep: int) -> DataFrame:
    """Commits older than a time, except the newest ``keep``. The log has one row per commit."""
    newest = snapshots.orderBy(F.desc(SNAPSHOT)).limit(keep).select(SNAPSHOT)
    old = snapshots.filter(F.col("committed_at") < F.lit(older_than).cast("timestamp"))
    return old.join(newest, SNAPSHOT, "left_anti")
