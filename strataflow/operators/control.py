"""The control log: one row per run event, and the processed-commit ledger read from it.

Events of a pipeline lie in numbered epochs, ``<pipeline>/e0``, ``e1`` and so on, each event in a folder of its
own that nothing moves or deletes. When an epoch is full, the ledger as of its end is written to the next
one as a single small file, and the next events go there. So a position is read from one fold and the
events of two epochs, however long the history; reports read all events.
"""

from __future__ import annotations

import logging
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

# Log columns and statuses.
CONTROL_SCHEMA = (
    "pipeline_name string, source_name string, batch_id string, ingest_ts timestamp, "
    "rows_read bigint, rows_written bigint, status string, notes string"
)
STARTED, SUCCESS, FAILED = "STARTED", "SUCCESS", "FAILED"
# Values that did not convert, counted per column: an event of its own, since a note of SUCCESS is a commit.
UNCONVERTED = "UNCONVERTED"
# Rows of a run that did not go the usual way (malformed, rejected, late, duplicate), by reason, as JSON.
COUNTED = "COUNTED"
# The last raw commit that a promotion of a stream has read to its end, as its note.
DRAINED = "DRAINED"
# The generation of a table that readers are to follow, as its note.
CURRENT = "CURRENT"
POINTERS = "generations"

#: Events of an epoch; the ledger is folded by the run that finds as many.
FOLD_AFTER = 64
FOLD = "_fold"  # hidden from readers of all events


def new_run_id() -> str:
    return str(uuid.uuid4())[:8]


def log_run(
    spark: SparkSession,
    path: str,
    pipeline: str,
    source: str,
    run_id: str,
    status: str,
    rows_read: int = 0,
    rows_written: int = 0,
    notes: str = "",
) -> None:
    """Append one run event with its whole note.

    A SUCCESS event is the ledger, so a run fails if it cannot be written; other events are
    best-effort, and problems become warnings.

    Each event has a folder of its own, so concurrent runs never share a commit folder; a pipeline's
    events can be read without listing the others'. The SUCCESS event that fills an epoch folds the ledger.
    """
    values = {
        "pipeline_name": F.lit(pipeline),
        "source_name": F.lit(source),
        "batch_id": F.lit(run_id),
        "ingest_ts": F.current_timestamp(),
        "rows_read": F.lit(rows_read).cast("bigint"),
        "rows_written": F.lit(rows_written).cast("bigint"),
        "status": F.lit(status),
        "notes": F.lit(notes),
    }
    try:
        event = spark.range(0, 1, 1, 1).select(*[v.alias(name) for name, v in values.items()])
        epoch = _epoch(spark, f"{path}/{pipeline}")
        event.write.mode("overwrite").parquet(f"{path}/{pipeline}/e{epoch}/{run_id}-{status}")
    except Exception as error:  # noqa: BLE001
        if status == SUCCESS:
            raise
        log.warning("control log %s not written: %s", path, error)
        return
    if status == SUCCESS:
        try:
            if len(_names(spark, f"{path}/{pipeline}/e{epoch}")) >= FOLD_AFTER:
                fold_ledger(spark, path, pipeline)
        except Exception as error:  # noqa: BLE001
            log.warning("ledger of %s not folded: %s", pipeline, error)  # the next run tries again


def _names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; nothing if there is no such folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [e.getPath().getName() for e in files.listStatus(folder)] if files.exists(folder) else []


def _is_epoch(name: str) -> bool:
    return name.startswith("e") and name[1:].isdigit()


def _epoch(spark: SparkSession, folder: str, names: list[str] | None = None) -> int:
    """The epoch that events go to: the newest whose fold was written to its end."""
    names = _names(spark, folder) if names is None else names
    for number in sorted((int(n[1:]) for n in names if _is_epoch(n)), reverse=True):
        if number and "_SUCCESS" in _names(spark, f"{folder}/e{number}/{FOLD}"):
            return number
    return 0


def read_ledger(spark: SparkSession, path: str, pipeline: str) -> DataFrame:
    """Enough of a pipeline's events to tell its positions: the newest fold and the events of two epochs.

    The epoch before the newest is read too: a run that chose its folder just before the fold may
    have written there after it. Empty when nothing has been logged.
    """
    folder = f"{path}/{pipeline}"
    names = _names(spark, folder)
    epoch = _epoch(spark, folder, names)
    parts = [f"{folder}/e{epoch}/{FOLD}"] if epoch else []
    parts += [f"{folder}/e{n}" for n in (epoch - 1, epoch) if f"e{n}" in names]
    if epoch == 0:  # a log begun before there were epochs
        parts += [f"{folder}/{n}" for n in names if not _is_epoch(n)]
    if not parts:
        return spark.createDataFrame([], CONTROL_SCHEMA)
    return spark.read.schema(CONTROL_SCHEMA).option("recursiveFileLookup", "true").parquet(*parts)


def fold_ledger(spark: SparkSession, path: str, pipeline: str) -> None:
    """Open the next epoch with the ledger so far: per status the event with the highest commit.

    The fold's size does not grow with the history. Until its last file is in place readers and writers
    stay with the epoch before, so a fold that breaks off changes nothing and can be repeated.
    """
    epoch = _epoch(spark, f"{path}/{pipeline}")
    reached = F.struct(F.coalesce(F.col("notes").try_cast("bigint"), F.lit(-1)), F.col("ingest_ts"))
    events = read_ledger(spark, path, pipeline).coalesce(1)
    highest = events.groupBy("status").agg(F.max_by(F.struct("*"), reached).alias("event"))
    highest.select("event.*").coalesce(1).write.mode("overwrite").parquet(f"{path}/{pipeline}/e{epoch + 1}/{FOLD}")


def point_to(spark: SparkSession, path: str, table: str, generation: int) -> None:
    """Make a generation of a table, ``<layer>.<name>``, the one that readers follow.

    One small file per table and generation number holds a time; the newest is the pointer. An earlier
    generation may be pointed to again.
    """
    event = spark.range(0, 1, 1, 1).select(
        F.lit(table).alias("pipeline_name"), F.lit(table).alias("source_name"), F.lit(new_run_id()).alias("batch_id"),
        F.current_timestamp().alias("ingest_ts"), F.lit(0).cast("bigint").alias("rows_read"),
        F.lit(0).cast("bigint").alias("rows_written"), F.lit(CURRENT).alias("status"),
        F.lit(str(generation)).alias("notes"))
    event.write.mode("overwrite").parquet(f"{path}/{POINTERS}/{table}/g{generation}")


def pointers(spark: SparkSession, path: str) -> dict[str, int]:
    """The generation that readers follow, by table; tables that were never rebuilt are not in it."""
    found = read_control(spark, f"{path}/{POINTERS}").filter(F.col("status") == CURRENT)
    number = F.col("notes").try_cast("int")
    newest = found.groupBy("pipeline_name").agg(F.max_by(number, F.struct("ingest_ts", number)).alias("generation"))
    return {r["pipeline_name"]: r["generation"] for r in newest.collect()}  # one row per table


def last_generation(spark: SparkSession, path: str, table: str) -> int:
    """The highest generation of a table that was ever pointed to; 0 if none was."""
    names = _names(spark, f"{path}/{POINTERS}/{table}")
    return max((int(n[1:]) for n in names if n[:1] == "g" and n[1:].isdigit()), default=0)


def read_control(spark: SparkSession, path: str) -> DataFrame:
    """The control log at ``path``; empty when nothing has been logged yet.

    ``<path>/<pipeline>`` reads the events of one pipeline.
    """
    reader = spark.read.schema(CONTROL_SCHEMA).option("recursiveFileLookup", "true")
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CONTROL_SCHEMA)


def runs_with_status(control: DataFrame, pipeline: str, status: str = SUCCESS) -> DataFrame:
    return control.filter((F.col("pipeline_name") == pipeline) & (F.col("status") == status))


def last_processed(control: DataFrame, pipeline: str, status: str = SUCCESS) -> DataFrame:
    """The highest commit a pipeline has finished, as one row ``(last_version)``, null if none.

    Successful runs keep it in their note; notes that are not numbers are ignored.
    """
    done = runs_with_status(control, pipeline, status)
    return done.agg(F.max(F.col("notes").try_cast("bigint")).alias("last_version"))


def ledger_position(control: DataFrame, pipeline: str, status: str = SUCCESS) -> int | None:
    """``last_processed`` as a number for planning a range; commit 0 is a valid position."""
    return last_processed(control, pipeline, status).first()["last_version"]


def recent_runs(control: DataFrame, n: int | None = None) -> DataFrame:
    """Run events, newest first; ``n`` limits the report."""
    ordered = control.select(
        "source_name", "status", "rows_written", "ingest_ts", "notes"
    ).orderBy(
        F.col("ingest_ts").desc(),
        *[F.col(c).desc() for c in ("source_name", "status", "rows_written", "notes")],
    )
    return ordered if n is None else ordered.limit(n)


def audit_as_control(
    audit: DataFrame, pipeline: str, source: str, now: Column | None = None
) -> DataFrame:
    """Batch audit rows in the control log's columns."""
    now = F.current_timestamp() if now is None else now
    notes = F.concat_ws(
        "; ",
        *[
            F.concat(F.lit(f"{c}="), F.col(c).cast("string"))
            for c in ("rows_rejected", "rows_late", "rows_duplicate")
        ],
    )
    return audit.select(
        F.lit(pipeline).alias("pipeline_name"),
        F.lit(source).alias("source_name"),
        F.col("_batch_id").cast("string").alias("batch_id"),
        now.alias("ingest_ts"),
        "rows_read",
        "rows_written",
        F.lit(SUCCESS).alias("status"),
        notes.alias("notes"),
    )
