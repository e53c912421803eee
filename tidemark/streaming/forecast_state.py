"""Streaming table forecast with keyed state (J8-J10, K6 on Structured Streaming).

The snapshots an online aggregate writes (one folder per batch) are read as
a file stream; each value column of each key is a series, kept by a
``transformWithStateInPandas`` processor (RocksDB state, checkpointed in the shared folder, so a
restarted query resumes):

* ``tip``: the candidates' state after the newest observation. One that comes in order moves it on, so a batch costs work
  proportional to the series it touches, however long the stream has run.
* ``held``: a map of observations by time. One that comes late is put in its place: the series is walked again from ``base``
  and the rows from that place on are given anew with a higher ``revision``; :func:`latest` keeps the newest of each. Whatever the order
  of the snapshots over batches, the latest rows are the batch form's. A replayed snapshot changes nothing.
* ``base`` and timers: with ``hold`` set, event time is the step counter and the watermark follows the newest step by ``hold``
  steps; a timer at each observation fires when the watermark passes it and folds it into ``base``, so ``held`` stays small.
  Spark then leaves out, and counts as dropped by watermark, what comes later than that. Without ``hold`` nothing is left out and ``held`` grows with the series.

The candidates are :class:`tidemark.operators.forecast.Estimator` objects, the same as in batch. Their weighted means are kept
as a mean and its total weight.
"""

from __future__ import annotations

import os
import uuid
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidemark.operators.forecast import ERROR_ALPHA, Estimator, Observation, checked, default_candidates
from tidemark.session import checkpoint_dir

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Selector:
    """The selector as steps over a flat list of numbers: first t and v, the last two times, the last value, the errors' weight and the number scored,
    then of each candidate the weight, the means, the mean error, slope and intercept."""

    HEAD = 7

    def __init__(self, final_time: float, candidates: list[Estimator] | None = None, error_alpha: float = ERROR_ALPHA):
        self.final_time, self.error_alpha = float(final_time), error_alpha
        self.candidates = checked(candidates or default_candidates())
        self.names = [list(e.observe(Observation(1.0, 1.0, 1.0, 1.0, 1.0))) for e in self.candidates]
        self.at = [self.HEAD]
        for names in self.names:
            self.at.append(self.at[-1] + len(names) + 4)

    @staticmethod
    def last_time(state: list[float]) -> float:
        return state[3]

    def step(self, state: list[float] | None, t: float, v: float) -> tuple[list[float], float, int | None]:
        """Take in one observation, later than all before; returns (state, forecast, chosen candidate or None)."""
        new = state is None
        s = [0.0] * self.at[-1] if new else list(state)
        if new:
            s[0], s[1] = t, v
        first_t, before_t, last_t, last_v = s[0], s[2], s[3], s[4]
        best, choice = float("inf"), None
        if not new:  # score the lines fitted on the earlier rows against this one
            s[5] = 1.0 + s[5] * self.error_alpha ** ((last_t - before_t) / first_t)
            s[6] += 1
            for i in range(len(self.candidates)):
                error, slope, icpt = (self.at[i + 1] - k for k in (3, 2, 1))
                s[error] += ((v - (s[slope] * t + s[icpt])) ** 2 - s[error]) / s[5]
                if s[error] <= best:  # ties to the last candidate
                    best, choice = s[error], i
        forecast = v if choice is None else s[self.at[choice + 1] - 2] * self.final_time + s[self.at[choice + 1] - 1]
        x = Observation(t, v, (v - last_v) / (t - last_t), first_t, s[1])
        for i, (e, names) in enumerate(zip(self.candidates, self.names)):
            lo = self.at[i]
            s[lo] = 1.0 + s[lo] * (1.0 if new or e.alpha == 1 else e.alpha ** ((t - last_t) / first_t))
            for k, q in enumerate(e.observe(x).values(), lo + 1):
                s[k] += (q - s[k]) / s[lo]
            s[self.at[i + 1] - 2], s[self.at[i + 1] - 1] = map(float, e.line(dict(zip(names, s[lo + 1:])), x))
        s[2], s[3], s[4] = last_t, t, v
        return s, float(forecast), choice


def step(state, t: float, v: float, final_time: float, candidates: list[Estimator] | None = None):
    """One step of the default selector: (state, forecast, chosen candidate or None)."""
    return Selector(final_time, candidates).step(state, t, v)


class SeriesProcessor(StatefulProcessor):
    """Forecasts of one series. Key: (keys..., value column)."""

    def __init__(self, selector: Selector, columns: list[str], timers: bool):
        self.selector, self.columns, self.timers = selector, columns, timers

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getMapState("held", "t double", "v double, part long")
        self.base = handle.getValueState("base", "s array<double>, n long")
        self.tip = handle.getValueState("tip", "s array<double>, revision long")

    def _base(self) -> list[float] | None:
        return list(self.base.get()[0]) if self.base.exists() else None

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        seen = sorted({(float(t), float(v), int(p)) for pdf in rows for t, v, p in zip(pdf["t"], pdf["val"], pdf["part_idx"]) if v == v})
        base = self._base()
        tip, revision = (list(self.tip.get()[0]), self.tip.get()[1]) if self.tip.exists() else (None, 0)
        new = [o for o in seen if (base is None or o[0] > Selector.last_time(base)) and not self._known(o)]
        if new:
            for t, v, part in new:
                self.held.updateValue((t,), (v, part))
                if self.timers:
                    self.handle.registerTimer(int(t * 1000))
            todo, state = new, tip
            if tip is not None and new[0][0] <= Selector.last_time(tip):
                todo, state, revision = sorted((k[0], *x) for k, x in self.held.iterator()), base, revision + 1
            out = []
            for t, v, part in todo:
                state, forecast, choice = self.selector.step(state, t, v)
                if t >= new[0][0]:
                    out.append((*key, part, forecast, choice, revision))
            self.tip.update((state, revision))
            yield pd.DataFrame(out, columns=self.columns).astype({"forecast_model": "Int32"})

    def _known(self, o: tuple) -> bool:
        return self.held.containsKey((o[0],)) and tuple(self.held.getValue((o[0],))) == o[1:]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        upto = expiredTimerInfo.getExpiryTimeInMs() / 1000
        base = self._base()
        for t, v in sorted((k[0], x[0]) for k, x in self.held.iterator() if k[0] <= upto):
            base, _, _ = self.selector.step(base, t, v)
            self.held.removeKey((t,))
        if base is not None:
            self.base.update((base, 0))
        yield from ()

    def close(self) -> None:
        pass


def forecast_state_stream(snapshots: DataFrame, keys: list[str], values: list[str], final_time: float,
                          out_path: str, name: str | None = None, candidates: list[Estimator] | None = None,
                          hold: int | None = None) -> StreamingQuery:
    """Stream of snapshots ``(part_idx, keys..., values...)`` -> forecasts
    ``(keys..., col, part_idx, forecast, forecast_model, revision)`` appended to
    ``out_path``, read with :func:`latest`; the step counter is ``part_idx + 1``. Null values are no observations.
    ``hold``: steps for which a late snapshot is still put in its place (None: without limit)."""
    spark = snapshots.sparkSession
    name = name or f"forecast_{uuid.uuid4().hex[:8]}"
    stack = "stack({}, {}) AS (col, val)".format(
        len(values), ", ".join(f"'{v}', CAST(`{v}` AS DOUBLE)" for v in values))
    long = snapshots.select(*keys, F.col("part_idx").cast("bigint").alias("part_idx"),
                            (F.col("part_idx") + 1).cast("double").alias("t"), F.expr(stack))
    if hold is not None:
        long = long.withColumn("at", F.timestamp_seconds("t")).withWatermark("at", f"{hold} seconds")
    key_types = {f.name: f.dataType.simpleString() for f in snapshots.schema.fields}
    schema = ", ".join([f"`{k}` {key_types[k]}" for k in keys]
                       + ["col string", "part_idx long", "forecast double", "forecast_model int", "revision long"])
    columns = [*keys, "col", "part_idx", "forecast", "forecast_model", "revision"]
    fc = long.groupBy(*keys, "col").transformWithStateInPandas(
        SeriesProcessor(Selector(final_time, candidates), columns, hold is not None), schema, "Append",
        "None" if hold is None else "EventTime")
    ckpt = os.path.join(checkpoint_dir(spark), "streams", name)
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, ROCKSDB)  # the query keeps the settings it starts with
    try:
        return (fc.writeStream.outputMode("append").format("parquet").option("path", out_path)
                .option("checkpointLocation", ckpt).queryName(name).trigger(availableNow=True).start())
    finally:
        spark.conf.set(setting, before) if before else spark.conf.unset(setting)


def latest(forecasts: DataFrame, keys: list[str]) -> DataFrame:
    """The newest revision of each forecast written by :func:`forecast_state_stream`."""
    row = F.max(F.struct("revision", "forecast", "forecast_model")).alias("x")
    return forecasts.groupBy(*keys, "col", "part_idx").agg(row).select(
        *keys, "col", "part_idx", "x.forecast", "x.forecast_model", "x.revision")
