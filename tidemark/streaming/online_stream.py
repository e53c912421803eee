"""Online aggregation on Structured Streaming.

A directory of part files is a finite stream of tables: one file per
micro-batch (``maxFilesPerTrigger=1``), ``trigger(availableNow=True)`` to
run to the end and stop. The running answer is Spark's own stateful
aggregation in ``complete`` mode; every micro-batch's result table is a
snapshot, written by ``foreachBatch`` under its batch id with ``overwrite``
so a replayed batch (after a failure) rewrites the same snapshot instead of
adding a second one.

State lives in the checkpoint under the cluster's shared
``spark.checkpoint.dir``; a restarted query resumes from it.
"""

from __future__ import annotations

import os
import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from tidemark.functions.exprs import rnd
from tidemark.operators.online import OnlineSpec, merged_states
from tidemark.session import checkpoint_dir


def file_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                files_per_trigger: int = 1, **options) -> DataFrame:
    """One file = one message."""
    r = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_trigger)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


def _finish(result: DataFrame, spec: OnlineSpec) -> DataFrame:
    """Finished values from columns ``__<aggregate>`` (states) and ``__rows``."""
    out = result.select(*spec.keys, *[a.value(F.col(f"__{a.name}")) for a in spec.aggs], F.col("__rows").cast("bigint").alias("rows_seen"))
    for d in spec.derived:
        v = F.expr(d.expr)
        out = out.withColumn(d.name, rnd(v, d.digits) if d.digits is not None else v)
    if spec.hidden:
        out = out.drop(*spec.hidden)
    return out


def _drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of our own on whatever file system it lies."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class _Merger:
    """Merged states of the batches so far, for accumulators that Spark's own state cannot merge: the states after batch b are
    written under b from those after b - 1 and the batch's partial ones, so a replayed batch writes the same again."""

    def __init__(self, spec: OnlineSpec, path: str):
        self.spec, self.path = spec, path

    def at(self, batch_id: int) -> str:
        return f"{self.path}/batch={batch_id}"

    def add(self, batch: DataFrame, batch_id: int) -> DataFrame:
        spec, spark = self.spec, batch.sparkSession
        states = F.struct(*[F.col(f"__{a.name}").alias(a.name) for a in spec.aggs])
        own = (batch.groupBy(*spec.keys).agg(*[a.partial().alias(f"__{a.name}") for a in spec.aggs], F.count(F.lit(1)).alias("__rows"))
               .select(*spec.keys, states.alias("__state"), "__rows", F.lit(1).alias("__age")))
        if not spec.keys:
            own = own.where("__rows > 0")  # the one row of a batch without rows
        if batch_id:
            own = own.unionByName(spark.read.parquet(self.at(batch_id - 1)).withColumn("__age", F.lit(0)))
        old, new = F.element_at("__both", 1), F.element_at("__both", -1)
        by_age = lambda a, b: a["age"] - b["age"]
        both = F.array_sort(F.collect_list(F.struct(F.col("__age").alias("age"), F.col("__state").alias("state"))), by_age)
        out = (own.groupBy(*spec.keys).agg(both.alias("__both"), F.sum("__rows").alias("__rows"))
               .select(*spec.keys, F.when(F.size("__both") == 1, new["state"]).otherwise(merged_states(spec, old["state"], new["state"])).alias("__state"), "__rows"))
        out.write.mode("overwrite").parquet(self.at(batch_id))
        if batch_id > 1:
            _drop_folder(spark, self.at(batch_id - 2))
        done = spark.read.parquet(self.at(batch_id))
        return done.select(*spec.keys, *[F.col("__state")[a.name].alias(f"__{a.name}") for a in spec.aggs], "__rows")


# ---------------------------------------------------------------- I7

def expected_rows(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", **options) -> int:
    """Rows that the files listed under ``path`` hold (Parquet: read off the footers)."""
    return spark.read.schema(schema).format(fmt).options(**options).load(path).count()


class ProgressListener(StreamingQueryListener):
    """Writes, after each micro-batch of one query, the observed rows of the batch to ``path/part_idx=<batch id>``."""

    def __init__(self, spark: SparkSession, name: str, path: str, rows_total: int):
        self.spark, self.name, self.path, self.rows_total, self.errors = spark, name, path, rows_total, []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name != self.name or OBSERVED not in p.observedMetrics:
            return
        try:
            n = p.observedMetrics[OBSERVED]["n"]
            self.spark.createDataFrame([(int(n), self.rows_total)], "n long, rows_total long").write.mode("overwrite").parquet(
                f"{self.path}/part_idx={p.batchId}")
        except Exception as e:  # noqa: BLE001 - a listener must not end the bus; run_to_end raises it
            self.errors.append(e)


OBSERVED = "online_rows"
_LISTENERS: dict[str, ProgressListener] = {}


def stream_progress(spark: SparkSession, out_path: str) -> DataFrame:
    """Per batch (part_idx) the source rows seen so far, those expected, and their ratio."""
    rows = spark.read.parquet(f"{out_path.rstrip('/')}_progress")
    w = Window.orderBy("part_idx").rowsBetween(Window.unboundedPreceding, 0)  # one row a batch
    seen = rows.select(F.col("part_idx").cast("bigint").alias("part_idx"), F.sum("n").over(w).alias("source_rows"), "rows_total")
    return seen.withColumn("progress", F.round(F.try_divide(F.col("source_rows").cast("double"), F.col("rows_total")), 4))


def forecast_sink(snap_path: str, out_path: str, keys: list[str], values: list[str], final_step: float):
    """J10 streaming twin, as an extra sink for :func:`online_agg_stream`:
    after snapshot ``b`` is written, every value column is forecast from the
    snapshots 0..b (step = part_idx + 1) and the forecasts for ``b`` are
    written under ``out_path/part_idx=b`` (overwrite, so a replayed batch
    rewrites the same result). The history read back is one row per key and
    snapshot, partitioned by key in the forecast windows; each batch re-reads
    it, so this suits tens to hundreds of snapshots. Long streams use
    :func:`tidemark.streaming.forecast_state.forecast_state_stream`, which
    keeps O(1) state per series."""
    from tidemark.operators.forecast import forecast_table

    def sink(snap: DataFrame, batch_id: int) -> None:
        spark = snap.sparkSession
        hist = (read_snapshots(spark, snap_path).where(F.col("part_idx") <= batch_id)
                .select("part_idx", *keys, *values)
                .withColumn("step", (F.col("part_idx") + 1).cast("double")))
        fc = forecast_table(hist, keys, values, "step", final_step)
        (fc.where(F.col("part_idx") == batch_id).drop("step")
         .write.mode("overwrite").parquet(os.path.join(out_path, f"part_idx={batch_id}")))
    return sink


def online_agg_stream(stream: DataFrame, spec: OnlineSpec, out_path: str, name: str | None = None,
                      transform: Callable[[DataFrame], DataFrame] | None = None,
                      extra_sinks: list[Callable[[DataFrame, int], None]] | None = None,
                      rows_total: int | None = None) -> StreamingQuery:
    """I2 (+I4 with ``transform`` joining complete static sides, I5 via the
    spec's derived columns, I6 with ``extra_sinks``, J10 with
    :func:`forecast_sink`, I7 with ``rows_total``). Snapshots land in ``out_path/part_idx=<batch id>``.

    Aggregates whose states SQL aggregates merge are Spark's own stateful aggregation; with any other
    :class:`tidemark.operators.online.Accumulator` each batch's partial states are merged with those written after the batch before.
    ``rows_total`` (see :func:`expected_rows`) turns on progress: the source's rows are counted as they pass by
    ``observe``, before any transform, and :func:`read_snapshots` adds ``rows_total`` and ``progress``."""
    spark = stream.sparkSession
    name = name or f"online_{uuid.uuid4().hex[:8]}"
    if rows_total is not None:
        _LISTENERS[name] = ProgressListener(spark, name, f"{out_path.rstrip('/')}_progress", rows_total)
        spark.streams.addListener(_LISTENERS[name])
        stream = stream.observe(OBSERVED, F.count(F.lit(1)).alias("n"))
    src = transform(stream) if transform else stream
    ckpt = os.path.join(checkpoint_dir(spark), "streams", name)
    own = all(a.fields() for a in spec.aggs)
    merger = None if own else _Merger(spec, f"{ckpt}-states")

    def write_snapshot(batch: DataFrame, batch_id: int) -> None:
        states = batch if own else merger.add(batch, batch_id)
        snap = _finish(states, spec).withColumn("part_idx", F.lit(batch_id).cast("bigint"))
        if extra_sinks:
            snap = snap.persist()
        # the part index lives in the folder name only
        snap.drop("part_idx").write.mode("overwrite").parquet(os.path.join(out_path, f"part_idx={batch_id}"))
        for sink in extra_sinks or []:
            sink(snap, batch_id)
        if extra_sinks:
            snap.unpersist()

    if own:
        src = src.groupBy(*spec.keys).agg(*[a.partial().alias(f"__{a.name}") for a in spec.aggs], F.count(F.lit(1)).alias("__rows"))
    return (src.writeStream.outputMode("complete" if own else "append").foreachBatch(write_snapshot)
            .option("checkpointLocation", ckpt).queryName(name)
            .trigger(availableNow=True).start())


def stream_map(stream: DataFrame, fn: Callable[[DataFrame], DataFrame], out_path: str,
               name: str | None = None, fmt: str = "parquet") -> StreamingQuery:
    """Stateless map (select / where / added columns) in append mode."""
    spark = stream.sparkSession
    name = name or f"map_{uuid.uuid4().hex[:8]}"
    ckpt = os.path.join(checkpoint_dir(spark), "streams", name)
    return (fn(stream).writeStream.outputMode("append").format(fmt).option("path", out_path)
            .option("checkpointLocation", ckpt).queryName(name).trigger(availableNow=True).start())


def run_to_end(query: StreamingQuery, timeout_s: float = 600.0) -> bool:
    """I8: wait for end of input; stop at the deadline. True if it finished."""
    done = query.awaitTermination(timeout_s)
    if not done:
        query.stop()
    if query.exception() is not None:
        raise query.exception()
    listener = _LISTENERS.pop(query.name, None)
    if listener:  # its last events may still be under way
        listener.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        listener.spark.streams.removeListener(listener)
        if listener.errors:
            raise listener.errors[0]
    return bool(done)


def run_until(query: StreamingQuery, stop, poll_s: float = 0.5, timeout_s: float | None = None) -> None:
    """I8 stop on signal: run a (continuous) query until ``stop`` -- a
    ``threading.Event`` or any object with ``is_set()`` -- is set, or the
    deadline passes; then stop it. State stays in the checkpoint, so a new
    start resumes where this one stopped."""
    import time
    t0 = time.monotonic()
    while query.isActive and not stop.is_set():
        if timeout_s is not None and time.monotonic() - t0 > timeout_s:
            break
        query.awaitTermination(poll_s)
    query.stop()
    if query.exception() is not None:
        raise query.exception()


def read_snapshots(spark: SparkSession, out_path: str, with_progress: bool = False) -> DataFrame:
    """Every snapshot written so far, tagged with its part index; I7: with ``rows_total`` and ``progress``."""
    snaps = spark.read.parquet(out_path).withColumn("part_idx", F.col("part_idx").cast("bigint"))
    if not with_progress:
        return snaps
    return snaps.join(F.broadcast(stream_progress(spark, out_path).drop("source_rows")), "part_idx", "left")  # one row a batch
