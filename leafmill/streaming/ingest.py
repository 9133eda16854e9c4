"""Streams: resumable ingest into an append log, its status, the latest record, and corrections applied once.

The log is a folder for each batch of the stream, written over if the batch is run again, so a
restart neither loses nor repeats records and never reads what the log has.  Records that
come again in a later batch are known by keyed state.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import UTC, datetime

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery, StreamingQueryListener
from pyspark.sql.types import LongType, StructType

from leafmill.operators.aggregates import latest_per_key
from leafmill.shared import Document

KEY = ("id", "recorded_at")


class Stopped(Exception):
    """A run was asked to stop, and does so before its next batch."""


def existing(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A log as it is, with the ``batch`` of each record; empty if it is not there yet."""
    whole = StructType.fromDDL(schema).add("batch", LongType())
    try:
        return spark.read.schema(whole).option("basePath", path).json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], whole)


def dispositions(items: DataFrame, log: DataFrame, files: DataFrame) -> DataFrame:
    """``skip`` (valid file, matching record), ``recover`` (valid file, no record) or ``fetch`` for each item."""
    last = latest_per_key(log, "id", "recorded_at").select("id", F.col("sha256").alias("said"))
    both = items.join(files, "id", "left").join(last, "id", "left")
    what = F.when(F.col("sha256").isNull(), "fetch").when(F.col("said").eqNullSafe(F.col("sha256")), "skip").otherwise("recover")
    return both.withColumn("disposition", what)


class Status(StreamingQueryListener):
    """Keeps the status document of an ingest: one replacement for each batch.

    Fields: ``state`` (running, interrupted, failed or complete), ``batches`` and ``rows`` of the log,
    ``last_id``, the greatest id in it, ``interruptions``, and when it changed.  What a batch
    brought comes from the metrics that it was observed with.  A run that starts counts
    the log anew, as the one before may have ended between its batch and the document.
    """

    METRICS = "ingest"

    def __init__(self, spark: SparkSession, path: str, log_path: str, schema: str, key: str = "id"):
        self.spark, self.document, self.query_id = spark, Document(spark, path), None
        self.ended, self.stopping, self.stopped = threading.Event(), threading.Event(), False
        before = self.document.read() or {"state": None, "interruptions": 0}
        if before["state"] == "running":  # it died without a word
            before["interruptions"] += 1
        log = existing(spark, log_path, schema)
        batches, rows, last = log.agg(F.count_distinct("batch"), F.count(F.lit(1)), F.max(key)).first()
        self.now = {"state": "running", "batches": batches, "rows": rows, "last_id": last, "interruptions": before["interruptions"]}
        self.replace()

    def replace(self, **changes: object) -> None:
        self.now |= changes
        self.document.replace(self.now | {"updated_at": datetime.now(UTC).isoformat(timespec="seconds")})

    def follow(self, query: StreamingQuery) -> None:
        self.query_id = str(query.runId)

    def onQueryStarted(self, event: object) -> None:
        pass

    def onQueryIdle(self, event: object) -> None:
        pass

    def onQueryProgress(self, event: object) -> None:
        row = event.progress.observedMetrics.get(self.METRICS)
        if self.query_id in (None, str(event.progress.runId)) and row is not None and row["rows"]:
            last = max((x for x in (self.now["last_id"], row["last_id"]) if x is not None), default=None)
            self.replace(batches=self.now["batches"] + 1, rows=self.now["rows"] + row["rows"], last_id=last)

    def onQueryTerminated(self, event: object) -> None:
        if self.query_id not in (None, str(event.runId)):
            return
        state = "complete" if event.exception is None else "interrupted" if self.stopped else "failed"
        self.replace(state=state, interruptions=self.now["interruptions"] + (state != "complete"))
        self.ended.set()

    def stop(self, query: StreamingQuery) -> dict:
        """Ends a run between two batches; the next one goes on from there."""
        self.stopping.set()
        return self.wait(query)

    def wait(self, query: StreamingQuery, seconds: float = 60) -> dict:
        """The document after the end of a run; what else than ``stop`` ended it is raised."""
        try:
            query.awaitTermination()
        except StreamingQueryException:
            if not self.stopped:
                raise
        finally:
            self.ended.wait(seconds)
            self.spark.streams.removeListener(self)
        return self.document.read()


def ingest(source: DataFrame, log_path: str, checkpoint: str, schema: str, key: tuple[str, ...] = KEY, status: Status | None = None) -> StreamingQuery:
    """Append each new record of a stream to a log, once (R1, R5, K6): a restart continues at its checkpoint."""
    names = StructType.fromDDL(schema).names
    new = source.dropDuplicates(list(key)).select(*names)
    new = new.observe(Status.METRICS, F.count(F.lit(1)).alias("rows"), F.max(key[0]).alias("last_id"))

    def append(batch: DataFrame, number: int) -> None:
        if status is not None and status.stopping.is_set():
            status.stopped = True
            raise Stopped(f"before batch {number}")
        batch.write.mode("overwrite").json(f"{log_path}/batch={number}")

    writer = new.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if status is not None:
        source.sparkSession.streams.addListener(status)
    query = writer.start()
    if status is not None:
        status.follow(query)
    return query


def latest(spark: SparkSession, log_path: str, schema: str) -> DataFrame:
    """The record written last for each id (R2)."""
    return latest_per_key(existing(spark, log_path, schema), "id", "recorded_at").drop("batch")


STATE_ROWS = 1 << 19  # records for which a partition of state is made


@contextmanager
def state_partitions(spark: SparkSession, records: int, least: int = 8) -> Iterator[None]:
    """Streams that are started within have as many partitions of state as their ``records`` need."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(max(least, -(-records // STATE_ROWS))))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


APPLIED = "page_id string, issue_no long, seq long, outcome string"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
WAITING = pa.schema({"at": pa.int64(), "seq": pa.int64(), "page_id": pa.string(), "issue_no": pa.int64(), "lines": pa.string()})
FIRST = pa.schema([WAITING.field(name) for name in ("page_id", "issue_no", "lines")])
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class AppliedOnce(StatefulProcessor):
    """Outcomes of the corrections of a bucket of pages: records wait until none before them can come, and are judged in order.

    State: the records that wait, and the lines of the first record of each page and issue.  Both are lists of
    Arrow tables, so a batch of a bucket is a few calls to the store, however many records it has.
    """

    PARTS = 32  # tables of one list before they are made one

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")
        self.first = handle.getListState("first", "rows binary")

    @staticmethod
    def packed(table: pa.Table) -> tuple[bytes]:
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, table.schema) as file:
            file.write_table(table)
        return (out.getvalue().to_pybytes(),)

    @staticmethod
    def unpacked(parts: list[tuple], schema: pa.Schema) -> pa.Table:
        return pa.concat_tables([schema.empty_table(), *(pa.ipc.open_stream(bytes(p[0])).read_all() for p in parts)])

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N803
        new = [pa.Table.from_pandas(batch[WAITING.names], WAITING, preserve_index=False) for batch in rows]
        self.waiting.appendList([self.packed(t) for t in new])
        self.handle.registerTimer(max(min(pc.min(t["at"]).as_py() for t in new), timerValues.getCurrentWatermarkInMs()) + 1)
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:  # noqa: N803
        rows = self.unpacked(list(self.waiting.get()), WAITING)
        past = pc.less(rows["at"], timerValues.getCurrentWatermarkInMs())
        due, later = rows.filter(past), rows.filter(pc.invert(past))
        if not due.num_rows:
            return
        if later.num_rows:
            self.waiting.put([self.packed(later)])
            self.handle.registerTimer(pc.min(later["at"]).as_py() + 1)
        else:
            self.waiting.clear()
        due = due.take(pc.sort_indices(due, [(name, "ascending") for name in WAITING.names], null_placement="at_start"))
        parts = list(self.first.get())
        known = {(page, issue): lines for page, issue, lines in zip(*self.unpacked(parts, FIRST).to_pydict().values(), strict=True)}
        new, outcomes = {}, []
        for page, issue, lines in zip(*due.select(FIRST.names).to_pydict().values(), strict=True):
            at = (page, issue)
            if at in known:
                outcomes.append("repeated" if known[at] == lines else "conflict")
            else:
                known[at] = new[at] = lines
                outcomes.append("applied")
        table = lambda own: pa.table([[p for p, _ in own], [i for _, i in own], [*own.values()]], FIRST)
        if len(parts) >= self.PARTS:
            self.first.put([self.packed(table(known))])
        elif new:
            self.first.appendList([self.packed(table(new))])
        yield due.select(["page_id", "issue_no", "seq"]).append_column("outcome", pa.array(outcomes, pa.string())).to_pandas()

    def close(self) -> None:
        pass


def applied_once(events: DataFrame, recorded_at: str, delay: str, buckets: int = 64) -> DataFrame:
    """(page_id, issue_no, seq, outcome) of a stream of corrections (page_id, issue_no, lines, seq).

    In the order of ``recorded_at`` and ``seq`` the first record of an issue is ``applied``, one
    with the same lines ``repeated``, another ``conflict``: whatever the order in which files
    come, as long as a record comes no more than ``delay`` after later ones.  An outcome is given
    when the watermark has passed the record; a record later than that is dropped.  Pages are dealt to
    ``buckets``; a task holds the waiting records and the first ones of a bucket.
    """
    lines = F.to_json(F.array_sort("lines"))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    rows = events.withWatermark(recorded_at, delay).select(
        F.pmod(F.xxhash64(page), F.lit(buckets)).alias("bucket"), page.alias("page_id"), F.col("issue_no").cast("long"), F.col("seq").cast("long"),
        lines.alias("lines"), F.col(recorded_at), F.unix_millis(recorded_at).alias("at"),
    )
    return rows.groupBy("bucket").transformWithStateInPandas(AppliedOnce(), APPLIED, "append", "eventTime")


def run_once(outcomes: DataFrame, path: str, checkpoint: str) -> None:
    """Runs a stream of ``applied_once`` over all that is there, into files at ``path``."""
    conf = outcomes.sparkSession.conf
    before = conf.get(STATE_STORE)
    conf.set(STATE_STORE, ROCKS)
    try:
        query = outcomes.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        query.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    finally:
        conf.set(STATE_STORE, before)


def run_counters(log: DataFrame) -> DataFrame:
    """Records by disposition."""
    return log.groupBy("disposition").agg(F.count(F.lit(1)).alias("n"))
