"""Versions of a parquet dataset as plain rows: read as of, restore, history, change feed, clone, compact.

Three datasets lie under the root. ``rows`` holds every row once, in the folder of the version that brought it and with a
number in that version. ``ended`` names the rows that a version ended, by those two numbers. ``operations`` has an audit row
per version. So a version is a filter on the version column and an anti join, a merge writes its source and the numbers of
the rows that it replaces, and a change feed is the rows brought and ended in its versions, matched by key.

A version counts once its audit row is there; what a job that died earlier left is written over by the next one. One
writer at a time is expected; two at once are not kept apart.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.predicates import all_present, true_only
from lakeops.operators.merge import change_rows, require_unique, update_where
from lakeops.operators.skew import lookup_join
from lakeops.session import materialize, one_row, path_exists
from lakeops.sources.layout import in_files
from lakeops.sources.readers import input_bytes, partitions_for

OPERATIONS = (
    "version bigint, commit_ts timestamp, operation string, row_count bigint, brought bigint, ended bigint, "
    "whole boolean, schema_json string, partition_by array<string>, tag string"
)
BORN, ROW = "_version", "_row"
PLACE = f"{BORN} bigint, {ROW} bigint"


@dataclass(frozen=True)
class VersionedTable:
    spark: SparkSession
    root: str

    # Versions

    def history(self) -> DataFrame:
        """The audit rows, newest first."""
        return self._operations().orderBy(F.col("version").desc())

    def current_version(self) -> int | None:
        """None before the first write."""
        entry = self._entry(F.lit(True))
        return None if entry is None else entry["version"]

    def version_at(self, when: datetime) -> int | None:
        """Last version written at or before ``when``."""
        entry = self._entry(F.col("commit_ts") <= F.lit(when))
        return None if entry is None else entry["version"]

    def has_commit(self, tag: str) -> bool:
        """Whether a version with this tag was written, so that a repeated job can leave it at that."""
        return self._entry(F.col("tag") == tag) is not None

    def _operations(self) -> DataFrame:
        if not path_exists(self.spark, f"{self.root}/operations"):
            return self.spark.createDataFrame([], OPERATIONS)
        return self.spark.read.schema(OPERATIONS).parquet(f"{self.root}/operations")

    def _entry(self, condition: Column):
        found = self._operations().where(condition).orderBy(F.col("version").desc()).head(1)
        return found[0] if found else None

    def _version_entry(self, version: int | None = None, as_of: datetime | None = None):
        if as_of is not None:
            version = self.version_at(as_of)
            if version is None:
                raise ValueError(f"{self.root} has no version at {as_of}")
        entry = self._entry(F.lit(True) if version is None else F.col("version") == version)
        if entry is None:
            raise ValueError(f"{self.root} has no version {'at all' if version is None else version}")
        return entry

    # Reads

    def read(self, version: int | None = None, as_of: datetime | None = None) -> DataFrame:
        """The table now, at a version, or as of a time."""
        return self._live(self._version_entry(version, as_of)).drop(BORN, ROW)

    def _base(self, version: int) -> int:
        """The last version up to this one that brought the whole table; no older row is alive after it."""
        return self._operations().where(F.col("whole") & (F.col("version") <= version)).agg(F.max("version")).first()[0]

    def _live(self, entry) -> DataFrame:
        """The rows of a version, with their numbers."""
        version = entry["version"]
        base = self._base(version)
        since = self._operations().where(F.col("version").between(base, version))
        rows = self._brought(since, _schema(entry))
        # What the base itself ended is older than its rows.
        ended = self._ended(since.where(F.col("version") > base))
        return rows if ended is None else lookup_join(rows, ended.select(BORN, ROW), [BORN, ROW], "left_anti")

    def _brought(self, operations: DataFrame, schema: T.StructType) -> DataFrame:
        """The rows that some versions brought, as columns of ``schema``; columns that came later are null."""
        wanted = operations.where("brought > 0").groupBy("partition_by").agg(F.collect_list("version").alias("versions"))
        parts = []
        for row in wanted.collect():  # few kinds of partitioning; the numbers of versions, not of rows
            home = self._home(row["partition_by"])
            reader = self.spark.read.schema(T.StructType([*schema, *T.StructType.fromDDL(PLACE)])).option("basePath", home)
            found = reader.parquet(*[f"{home}/{BORN}={version}" for version in sorted(row["versions"])])
            parts.append(found.select(*schema.names, BORN, ROW))
        if not parts:
            return self.spark.createDataFrame([], T.StructType([*schema, *T.StructType.fromDDL(PLACE)]))
        return reduce(DataFrame.unionByName, parts)

    def _ended(self, operations: DataFrame) -> DataFrame | None:
        """The numbers of rows that some versions ended, and the version that ended them as ``_by``."""
        versions = [row["version"] for row in operations.where("ended > 0").select("version").collect()]
        if not versions:
            return None
        home = f"{self.root}/ended"
        reader = self.spark.read.schema(f"{PLACE}, _by bigint").option("basePath", home)
        return reader.parquet(*[f"{home}/_by={version}" for version in sorted(versions)])

    def _home(self, partition_by: Sequence[str]) -> str:
        return "-".join([f"{self.root}/rows", *partition_by])

    # Writes

    def overwrite(
        self, df: DataFrame, operation: str = "WRITE", partition_by: Sequence[str] = (), tag: str | None = None
    ) -> int:
        """Replace all rows, and the columns and the partitioning with them."""
        last = self._entry(F.lit(True))
        old = None if last is None else self._live(last)
        return self._commit(last, operation, df, old, df.schema, partition_by, whole=True, tag=tag)

    def append(self, df: DataFrame, merge_schema: bool = False) -> int:
        """Add rows; with ``merge_schema`` new columns join the table and are null in older rows."""
        entry = self._entry(F.lit(True))
        if entry is None:
            return self.overwrite(df, "APPEND")
        schema = _schema(entry)
        extra = [T.StructField(f.name, f.dataType) for f in df.schema if f.name not in schema.names]
        if extra and not merge_schema:
            raise ValueError(f"the table has no columns {[field.name for field in extra]}")
        if extra:
            self._refuse_dropped([field.name for field in extra])
        schema = T.StructType([*schema, *extra])
        rows = df.select(
            *[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
        )
        return self._commit(entry, "APPEND", rows, None, schema)

    def merge(self, source: DataFrame, keys: Sequence[str], tag: str | None = None) -> int:
        """Replace the rows whose key is in the source and add the others.

        Only the keys of the table are read, and only the source is written, so one key may hold any part of the table.
        Missing keys match nothing. Extra columns of the source are ignored; several rows with one key are an error.
        """
        entry = self._version_entry()
        schema = _schema(entry)
        absent = [name for name in schema.names if name not in source.columns]
        if absent:
            raise ValueError(f"the source lacks the columns {absent}")
        source = materialize(source.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]), "merge-source")
        require_unique(source, keys)
        wanted = source.where(all_present(keys)).select(*keys)
        replaced = lookup_join(self._live(entry).select(*keys, BORN, ROW), wanted, keys, "left_semi")
        return self._commit(entry, "MERGE", source, replaced, schema, tag=tag)

    def update(self, condition: Column, values: Mapping[str, Column]) -> int:
        entry = self._version_entry()
        hit = materialize(self._live(entry).where(true_only(condition)), "updated-rows")
        return self._commit(entry, "UPDATE", update_where(hit.drop(BORN, ROW), condition, values), hit, _schema(entry))

    def delete(self, condition: Column) -> int:
        """End the rows for which the condition is true; unknown is not true."""
        entry = self._version_entry()
        return self._commit(entry, "DELETE", None, self._live(entry).where(true_only(condition)), _schema(entry))

    def drop_columns(self, *names: str) -> int:
        """Leave columns out of the table from now on; no row is written."""
        entry = self._version_entry()
        schema = T.StructType([field for field in _schema(entry) if field.name not in names])
        return self._commit(entry, "DROP COLUMNS", None, None, schema)

    def _refuse_dropped(self, names: Sequence[str]) -> None:
        # Distinct schemas: as many as the table's columns were changed.
        schemas = self._operations().select("schema_json").distinct().collect()
        again = {name for row in schemas for name in _schema(row).names} & set(names)
        if again:
            raise ValueError(f"older files may still hold the dropped columns {sorted(again)}")

    def restore(self, version: int | None = None, as_of: datetime | None = None) -> int:
        """Bring back an earlier version as the newest one; later versions stay in the history.

        Rows that came since are ended, and rows ended since are brought again; all others stay where they are.
        """
        entry, now = self._version_entry(version, as_of), self._version_entry()
        then = self._live(entry)
        later = self._operations().where(F.col("version") > entry["version"])
        whole = later.where("whole").head(1) != []
        ended = self._ended(later)
        if whole:
            lost = then
        elif ended is None:
            lost = None
        else:
            lost = lookup_join(then, ended.select(BORN, ROW), [BORN, ROW], "left_semi")
        current = self._live(now)
        since = current if whole else current.where(F.col(BORN) > entry["version"])
        lost = None if lost is None else lost.drop(BORN, ROW)
        return self._commit(now, "RESTORE", lost, since, _schema(entry), entry["partition_by"], whole)

    def deep_clone(self, root: str, version: int | None = None) -> VersionedTable:
        """Copy a version's rows to a dataset of its own."""
        clone = VersionedTable(self.spark, root)
        clone.overwrite(self.read(version), "CLONE", self._version_entry(version)["partition_by"])
        return clone

    def compact(self, target_mb: int = 128) -> int:
        """Write the rows of now once more, in files of about ``target_mb``; a change feed passes over it."""
        entry = self._version_entry()
        df = self._live(entry)
        since = self._operations().where(F.col("version") >= self._base(entry["version"]))
        files = partitions_for(input_bytes(self._brought(since, _schema(entry))), target_mb)
        rows = in_files(df.drop(BORN, ROW), files)
        return self._commit(entry, "OPTIMIZE", rows, df, _schema(entry), entry["partition_by"], whole=True)

    def _commit(
        self,
        last,
        operation: str,
        brought: DataFrame | None,
        ended: DataFrame | None,
        schema: T.StructType,
        partition_by: Sequence[str] | None = None,
        whole: bool = False,
        tag: str | None = None,
    ) -> int:
        """Write a version's rows and ended numbers, and then its audit row; partitioning stays unless given."""
        version = 0 if last is None else last["version"] + 1
        partition_by = list(last["partition_by"] if partition_by is None else partition_by)
        taken = {BORN, ROW} & set(schema.names)
        if taken:
            raise ValueError(f"the columns {sorted(taken)} are the table's own")
        new = 0
        if brought is not None:
            if partition_by:
                brought = brought.hint("rebalance", *partition_by)
            numbered = brought.withColumn(ROW, F.monotonically_increasing_id())
            new = _counted(numbered, f"{self._home(partition_by)}/{BORN}={version}", partition_by)
        gone = 0
        if ended is not None:
            gone = _counted(ended.select(BORN, ROW), f"{self.root}/ended/_by={version}")
        entry = {
            "version": version,
            "commit_ts": datetime.now(timezone.utc),
            "operation": operation,
            "row_count": (0 if last is None else last["row_count"]) + new - gone,
            "brought": new,
            "ended": gone,
            "whole": whole,
            "schema_json": schema.json(),
            "partition_by": partition_by,
            "tag": tag,
        }
        one_row(self.spark, entry, OPERATIONS).write.mode("append").parquet(f"{self.root}/operations")
        return version

    # Change feed

    def change_feed(self, keys: Sequence[str], start: int, end: int | None = None) -> DataFrame:
        """Changes made by each version from ``start`` to ``end``, with version and commit time.

        Only rows that these versions brought or ended are read; they meet in one shuffle by version and key.
        """
        operations = self._operations()
        end = operations.agg(F.max("version")).first()[0] if end is None else end
        known = operations.where(F.col("version").isin([start, end if end is not None else start])).count()
        if end is None or start > end or known < len({start, end}):
            raise ValueError(f"{self.root} has no versions from {start} to {end}")
        # Rows that are only written anew do not change.
        mine = operations.where(F.col("version").between(start, end) & (F.col("operation") != "OPTIMIZE"))
        shown = operations.where(F.col("version").between(start - 1, end)).orderBy("version")
        schema = T.StructType([])
        for row in shown.groupBy("schema_json").agg(F.min("version").alias("first")).orderBy("first").collect():
            schema = T.StructType([*schema, *[f for f in _schema(row) if f.name not in schema.names]])
        came = self._brought(mine, schema).withColumn("_commit_version", F.col(BORN)).drop(BORN, ROW)
        ended = self._ended(mine)
        if ended is None:
            changes = came.withColumn("_change_type", F.lit("insert"))
        else:
            # Only folders that an ended row lies in: numbers of versions, not of rows.
            born = [row[BORN] for row in ended.select(BORN).distinct().collect()]
            former = self._brought(operations.where(F.col("version").isin(born)), schema)
            went = lookup_join(former, ended.withColumnRenamed("_by", "_commit_version"), [BORN, ROW], "inner")
            changes = change_rows(went.drop(BORN, ROW), came, ["_commit_version", *keys])
        times = operations.select(F.col("version").alias("_commit_version"), F.col("commit_ts").alias("_commit_timestamp"))
        return lookup_join(changes, times, ["_commit_version"], "inner").select(
            *schema.names, "_change_type", "_commit_version", "_commit_timestamp"
        )


def _counted(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Write the rows, over what may be left there, and count them on the way."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return seen.get["rows"]


def _schema(entry) -> T.StructType:
    return T.StructType.fromJson(json.loads(entry["schema_json"]))
