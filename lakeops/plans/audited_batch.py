"""Batch writes with an audit trail, and rollback of batches that failed."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.ranking import latest_per_key
from lakeops.session import one_row, path_exists
from lakeops.sources.snapshots import VersionedTable

# Columns of an audit row.
AUDIT_SCHEMA = (
    "batch_id string, timestamp timestamp, source_path string, record_count bigint, "
    "delta_table_version bigint, status string, rollback_flag string, rollback_table_version bigint"
)
# And two of our own: what failed, and the order of rows with one timestamp.
AUDIT_SCHEMA += ", error string, entry bigint"


@dataclass(frozen=True)
class AuditLog:
    """Append-only audit rows; the newest row of a batch is its state."""

    spark: SparkSession
    path: str

    def rows(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], AUDIT_SCHEMA)
        return self.spark.read.schema(AUDIT_SCHEMA).parquet(self.path)

    def add(
        self,
        batch_id: str,
        source_path: str | None,
        record_count: int | None,
        version: int | None,
        status: str,
        rolled_back_to: int | None = None,
        error: str | None = None,
    ) -> None:
        row = {
            "batch_id": batch_id,
            "timestamp": datetime.now(timezone.utc),
            "source_path": source_path,
            "record_count": record_count,
            "delta_table_version": version,
            "status": status,
            "rollback_flag": "N" if rolled_back_to is None else "Y",
            "rollback_table_version": rolled_back_to,
            "error": error,
            "entry": time.time_ns(),
        }
        one_row(self.spark, row, AUDIT_SCHEMA).write.mode("append").parquet(self.path)

    def states(self) -> DataFrame:
        """The newest row of every batch."""
        return latest_per_key(self.rows(), ["batch_id"], [F.col("timestamp").desc(), F.col("entry").desc()])

    def latest(self, batch_id: str):
        found = self.rows().where(F.col("batch_id") == batch_id).orderBy(F.desc("timestamp"), F.desc("entry")).head(1)
        if not found:
            raise ValueError(f"no audit row for batch {batch_id}")
        return found[0]

    def latest_by_status(self):
        """Newest failed batch with its version, and version of the newest successful one, in one pass."""

        def newest(column: str, status: str):
            return f"max_by({column}, struct(timestamp, entry)) filter (where status = '{status}')"

        return self.rows().selectExpr(
            f"{newest('batch_id', 'FAILED')} as failed_batch",
            f"{newest('delta_table_version', 'FAILED')} as failed_version",
            f"{newest('delta_table_version', 'SUCCESS')} as success_version",
        ).first()


def rollback_batch(table: VersionedTable, audit: AuditLog, batch_id: str, version: int) -> int:
    """Restore the table to a version and record it for the batch; returns the new version."""
    batch = audit.latest(batch_id)
    restored = table.restore(version)
    audit.add(batch_id, batch["source_path"], batch["record_count"], restored, "SUCCESS", version)
    return restored


def rollback_if_needed(table: VersionedTable, audit: AuditLog) -> int | None:
    """Roll the newest failed batch back if it left a later version than the newest successful one."""
    state = audit.latest_by_status()
    failed, good = state["failed_version"], state["success_version"]
    if failed is None or good is None or failed <= good:
        return None
    return rollback_batch(table, audit, state["failed_batch"], good)


def audited_write(
    build: Callable[[], DataFrame],
    table: VersionedTable,
    audit: AuditLog,
    source_path: str,
    record_count: int | None = None,
    partition_by: Sequence[str] = (),
    batch_id: str | None = None,
    raises: bool = False,
) -> str:
    """Overwrite the table with what ``build`` returns, recording the start and the outcome.

    A failed write is recorded with its error, and undone if it got as far as a new version; it is raised on only
    if ``raises``. Returns the batch id.
    """
    batch_id = batch_id or str(uuid.uuid4())
    audit.add(batch_id, source_path, record_count, table.current_version(), "STARTED")
    try:
        table.overwrite(build(), partition_by=partition_by)
    except Exception as error:  # noqa: BLE001 - the audit row is the report
        audit.add(batch_id, source_path, record_count, table.current_version(), "FAILED", error=str(error)[:2000])
        rollback_if_needed(table, audit)
        if raises:
            raise
    else:
        audit.add(batch_id, source_path, record_count, table.current_version(), "SUCCESS")
    return batch_id
