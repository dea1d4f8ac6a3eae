"""Event-time ordered folds per key with ``transformWithStateInPandas``.

Micro-batches may deliver a key's rows out of event-time order. The state of
a key is typed: a value (the fold's carry) and a list (rows not yet applied).
A row is applied once the watermark has passed its event time; an event-time
timer at the oldest waiting row brings the key back when the watermark
moves, even without new data. A row that is older than the watermark when it
arrives is *late*: rows after it may have been applied already. Late rows
are returned, column by column, beside the fold's output, so that nothing is
lost unseen.

Spark itself drops late rows in front of a stateful operator if the
operator's input has the watermarked column. Here the event time goes in as
microseconds, an expression over that column: the watermark and its timers
stay, and late rows reach the operator.

Every row is applied in exact (time, id) order or is late, whatever the
arrival order: a row is applied only behind the watermark, and a row that
arrives behind the watermark is late. The list holds at most the rows of one
watermark delay for a key, so state stays bounded by (event rate x delay),
not by history.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

TIME = "event_us"  # event time in microseconds since the epoch (no leading underscore: the rows come as named tuples)
LATE = "_late"  # true on rows that came too late
LATE_PREFIX = "_late_"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# fold(key, carry (dict or None), rows sorted by (time, id)) -> (carry, out)
Fold = Callable[[tuple, dict | None, pd.DataFrame], tuple[dict, pd.DataFrame]]


@contextlib.contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, which typed state
    and timers need; the session's own choice comes back afterwards."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def plain(value):
    """A Python value as the state stores it (missing: None)."""
    if value is None or (not isinstance(value, str) and pd.isna(value)):
        return None
    return value.item() if hasattr(value, "item") else value


def stored(frame: pd.DataFrame, schema: T.StructType) -> list[tuple]:
    """The rows of a frame as values of the schema (pandas turns integers
    beside missing values into floats)."""
    whole = [isinstance(f.dataType, T.IntegralType) for f in schema.fields]
    rows = ([plain(v) for v in row] for row in frame[schema.fieldNames()].itertuples(index=False))
    return [tuple(int(v) if w and v is not None else v for v, w in zip(row, whole, strict=True)) for row in rows]


class OrderedFold(StatefulProcessor):
    """Applies ``fold`` to each key's rows in (time, id) order."""

    def __init__(self, fold: Fold, id_col: str, rows: T.StructType, carry: T.StructType, out: T.StructType) -> None:
        self.fold, self.id_col, self.rows, self.carry, self.out = fold, id_col, rows, carry, out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.carried = handle.getValueState("carry", self.carry)
        self.waiting = handle.getListState("waiting", self.rows)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        names = self.rows.fieldNames()
        horizon = timerValues.getCurrentWatermarkInMs() * 1000
        first = None
        for frame in rows:
            if not len(frame):
                continue
            late = frame[TIME] < horizon
            if late.any():
                yield self._late(frame[late])
            on_time = frame.loc[~late, names]
            if len(on_time):
                first = min(int(on_time[TIME].min()), first if first is not None else int(on_time[TIME].min()))
                self.waiting.appendList(stored(on_time, self.rows))
        if first is not None:
            self._wake(first)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        horizon = timerValues.getCurrentWatermarkInMs() * 1000
        held = pd.DataFrame(list(self.waiting.get()) if self.waiting.exists() else [], columns=self.rows.fieldNames())
        held = held.sort_values([TIME, self.id_col], kind="mergesort").reset_index(drop=True)
        ready, wait = held[held[TIME] < horizon], held[held[TIME] >= horizon]
        if not len(ready):
            return
        before = dict(zip(self.carry.fieldNames(), self.carried.get(), strict=True)) if self.carried.exists() else None
        after, out = self.fold(key, before, ready)
        self.carried.update(tuple(after[f] for f in self.carry.fieldNames()))
        self.waiting.clear()
        if len(wait):
            self.waiting.put(stored(wait, self.rows))
            self._wake(int(wait[TIME].min()))
        if len(out):
            yield self._filled(out, late=False)

    def _wake(self, first_us: int) -> None:
        """A timer at the first moment at which the watermark is past a row."""
        self.handle.registerTimer(first_us // 1000 + 1)

    def _late(self, rows: pd.DataFrame) -> pd.DataFrame:
        return self._filled(rows.rename(columns={c: LATE_PREFIX + c for c in rows.columns}), late=True)

    def _filled(self, frame: pd.DataFrame, late: bool) -> pd.DataFrame:
        return frame.assign(**{LATE: late}).reindex(columns=self.out.fieldNames()).astype(object).where(lambda f: f.notna(), None)

    def close(self) -> None:
        pass


def ordered_fold(
    stream: DataFrame, keys: list[str], fold: Fold, time_col: str, id_col: str, columns: list[str],
    carry: T.StructType, output_schema: T.StructType,
) -> DataFrame:
    """Apply ``fold`` per key in event-time order over a watermarked stream.

    The fold sees ``columns`` and ``event_us``; ``carry`` is the
    schema of what it hands on. The result has ``output_schema``, ``_late``
    and, for late rows, the input columns as ``_late_<name>``. Start the
    query inside ``keyed_state``."""
    flat = stream.select(*keys, F.unix_micros(F.col(time_col)).alias(TIME), *(c for c in columns if c not in keys))
    rows = T.StructType([f for f in flat.schema.fields if f.name not in keys or f.name in columns])
    late = [T.StructField(LATE_PREFIX + f.name, f.dataType) for f in flat.schema.fields]
    out = T.StructType([T.StructField(f.name, f.dataType) for f in output_schema.fields] + [T.StructField(LATE, T.BooleanType())] + late)
    processor = OrderedFold(fold, id_col, rows, carry, out)
    return flat.groupBy(*keys).transformWithStateInPandas(processor, out, "Append", "EventTime")


def on_time(out: DataFrame, columns: list[str]) -> DataFrame:
    """The fold's output of a sink that ``ordered_fold`` has filled."""
    return out.filter(~F.col(LATE)).select(*columns)


def late_rows(out: DataFrame, time_col: str) -> DataFrame:
    """The late input rows of such a sink, with their event time."""
    names = [c.removeprefix(LATE_PREFIX) for c in out.columns if c.startswith(LATE_PREFIX)]
    rows = out.filter(LATE).select(*(F.col(LATE_PREFIX + c).alias(c) for c in names))
    return rows.withColumn(time_col, F.timestamp_micros(TIME).cast("timestamp_ntz")).drop(TIME)
