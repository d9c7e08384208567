"""Stateful stream operators with state of their own: lag, first write wins, averages that can be re-keyed.

Each is a ``StatefulProcessor`` run by ``transformWithStateInPandas``: rows reach a key
in Arrow batches, state lies in RocksDB under the query's checkpoint, and a restarted
query goes on from there.  Where several rows of a key can be combined before they meet
its state, they are, in the partition they arrive in, so a source that sends a third of
all records sends a handful of rows per partition and trigger.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..schema import METRICS


def _typed(rows: list[tuple], schema: T.StructType) -> pd.DataFrame:
    """Rows as a frame whose whole-number columns may hold nulls and whose times stay wall-clock times."""
    out = {}
    for i, f in enumerate(schema.fields):
        values = [r[i] for r in rows]
        if isinstance(f.dataType, (T.LongType, T.IntegerType)):
            out[f.name] = pd.array(values, dtype="Int64" if isinstance(f.dataType, T.LongType) else "Int32")
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            out[f.name] = pd.Series(values, dtype="datetime64[us]")
        else:
            out[f.name] = pd.Series(values, dtype=object if isinstance(f.dataType, T.StringType) else None)
    return pd.DataFrame(out)


def _plain(v, kind: T.DataType):
    """A state value of this type from a pandas cell; a column of whole numbers with nulls arrives as doubles."""
    if v is None or v is pd.NaT or v is pd.NA or v != v:
        return None
    if isinstance(kind, T.IntegralType):
        return int(v)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    return v.item() if hasattr(v, "item") else v


# ---------------------------------------------------------------- lag

class _Lag(StatefulProcessor):
    """Rows wait until the watermark has passed them, then leave in order with the value before them."""

    def __init__(self, rows: T.StructType, order: list[str], value: str, out: T.StructType):
        self.rows, self.out = rows, out
        names = rows.fieldNames()
        self.order, self.value, self.time = [names.index(c) for c in order], names.index(value), names.index(order[0])
        self.value_type = rows[value].dataType

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.rows)
        self.last = handle.getValueState("last", T.StructType([T.StructField("value", self.value_type)]))

    def _millis(self, row: tuple) -> int:
        # rounded up: a row is ready once the watermark has reached it, since rows up to the watermark count as late
        return -int(-(row[self.time] - pd.Timestamp(0)).total_seconds() * 1e6 // 1000)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        untimed, timed, types = [], [], [f.dataType for f in self.rows.fields]
        for pdf in rows:
            for r in pdf.iloc[:, :len(types)].itertuples(index=False, name=None):
                r = tuple(map(_plain, r, types))
                (untimed if r[self.time] is None else timed).append(r)
        if timed:
            self.waiting.appendList(timed)
            self.handle.registerTimer(min(map(self._millis, timed)))
        if untimed:
            yield _typed([(*r, None) for r in untimed], self.out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        upto = timerValues.getCurrentWatermarkInMs()
        ready, later = [], []
        for r in self.waiting.get():
            (ready if self._millis(r) <= upto else later).append(tuple(r))
        if not ready:
            return
        ready.sort(key=lambda r: tuple((r[i] is not None, r[i]) for i in self.order))
        held = self.last.get() if self.last.exists() else (None,)
        out = []
        for r in ready:
            out.append((*r, held[0]))
            held = (r[self.value],)
        self.last.update(held)
        if later:
            self.waiting.put(later)
            self.handle.registerTimer(min(map(self._millis, later)))
        else:
            self.waiting.clear()
        yield _typed(out, self.out)

    def close(self) -> None:
        pass


def lag_stream(logs: DataFrame, key: str = "src_ip", order: list[str] | None = None, value: str = "unq_dst_ip",
               out: str = "prev_unq_dst_ip", delay: str = "0 seconds") -> DataFrame:
    """The lag feature where the data arrives: each row with the ``value`` of its key's row before it.

    ``order`` (default ``timestamp, event_id``) is a total order within a key, its first
    column the event time.  Rows may arrive out of order by up to ``delay``; a row leaves
    once the watermark has reached its time, so the last rows wait for a later record of
    any key.  State per key: the rows that wait, and one value.  Rows later than ``delay``
    are dropped, as a watermark does.  A row without a time has no place in the order:
    it leaves at once with a null lag and is nobody's predecessor.
    """
    order = order or ["timestamp", "event_id"]
    schema = T.StructType([*logs.schema.fields, T.StructField(out, logs.schema[value].dataType)])
    timed = logs.withColumn("_event_time", F.col(order[0]).cast("timestamp")).withWatermark("_event_time", delay)
    return timed.groupBy(key).transformWithStateInPandas(
        _Lag(logs.schema, order, value, schema), schema, "append", "eventTime")


# ---------------------------------------------------------------- first write wins

def add_cells(starts: list[int], ends: list[int], cells: list[int]) -> list[int]:
    """Add grid cells to sorted, disjoint, merged intervals ``[start, end)`` in place; returns the cells that are new."""
    new = []
    for c in cells:
        i = bisect_right(starts, c) - 1
        if i >= 0 and c < ends[i]:
            continue
        new.append(c)
        left, right = i >= 0 and ends[i] == c, i + 1 < len(starts) and starts[i + 1] == c + 1
        if left and right:
            ends[i] = ends.pop(i + 1)
            starts.pop(i + 1)
        elif left:
            ends[i] = c + 1
        elif right:
            starts[i + 1] = c
        else:
            starts.insert(i + 1, c)
            ends.insert(i + 1, c + 1)
    return new


class _FirstWrite(StatefulProcessor):
    """The cells of a key that have been written, as merged intervals."""

    def __init__(self, schema: T.StructType):
        self.schema = schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        cells = T.ArrayType(T.LongType())
        self.seen = handle.getValueState("seen", T.StructType([T.StructField("starts", cells), T.StructField("ends", cells)]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows))
        first = pdf.sort_values("arrival", kind="stable").drop_duplicates("cell")
        held = self.seen.get() if self.seen.exists() else ([], [])
        starts, ends = list(held[0]), list(held[1])
        new = add_cells(starts, ends, sorted(map(int, first["cell"])))
        if new:
            self.seen.update((starts, ends))
            yield first[first["cell"].isin(new)][self.schema.fieldNames()]

    def close(self) -> None:
        pass


def first_write_stream(logs: DataFrame, metrics: list[str] | None = None, key: str = "src_ip", ts: str = "timestamp",
                       arrival: str = "event_id", step_seconds: int = 3600) -> DataFrame:
    """First write wins on a stream: one record per key and grid cell ``(ip, ds, arrival, metrics...)``, ever.

    The cell of a record is its time rounded down to ``step_seconds``; its first arrival
    is kept and every later write is rejected, however late it comes: nothing expires.
    In a trigger the smallest ``arrival`` is first.  State per key is one list of merged
    intervals of cells, so its size is the number of gaps in the key's log, not the
    number of records.  Records of a cell are combined in the partition they arrive in.
    Records without a time have no cell and are left out.
    """
    metrics = metrics or METRICS
    cell = F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / step_seconds).cast("long")
    cells = logs.where(F.col(ts).isNotNull()).select(
        F.col(key).alias("ip"), F.timestamp_seconds(cell * step_seconds).cast("timestamp_ntz").alias("ds"),
        F.col(arrival).alias("arrival"), *[F.col(m).cast("double").alias(m) for m in metrics], cell.alias("cell"))

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.sort_values("arrival", kind="stable").drop_duplicates(["ip", "cell"])

    out = T.StructType(cells.schema.fields[:-1])
    return cells.mapInPandas(combine, cells.schema).groupBy("ip").transformWithStateInPandas(_FirstWrite(out), out, "append", "none")


# ---------------------------------------------------------------- averages from a given state

class _Average(StatefulProcessor):
    """Sum and count per key; a new query may start from the sums of an earlier one."""

    def __init__(self, schema: T.StructType):
        self.schema = schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("sums", T.StructType([T.StructField("total", T.DoubleType()), T.StructField("n", T.LongType())]))

    def _add(self, rows) -> tuple[float, int]:
        total, n = self.held.get() if self.held.exists() else (0.0, 0)
        for pdf in rows:
            total, n = total + float(pdf["total"].fillna(0).sum()), n + int(pdf["n"].sum())
        self.held.update((total, n))
        return total, n

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self._add([initialState])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        total, n = self._add(rows)
        yield pd.DataFrame({self.schema.names[0]: pd.Series([key[0]], dtype=object),
                            self.schema.names[1]: pd.Series([total / n if n else None], dtype="float64")})

    def close(self) -> None:
        pass


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state a stopped running average left: ``(key..., total, n)``, one row per key.

    Read with the state data source, as a table: an audit needs no running query.
    """
    state = spark.read.format("statestore").load(checkpoint)
    sums = [f.name for f in state.schema["value"].dataType.fields]  # the average's buffer: sum, then count
    return state.select("key.*", F.col(f"value.{sums[0]}").cast("double").alias("total"), F.col(f"value.{sums[1]}").cast("long").alias("n"))


def running_average_from(logs: DataFrame, initial: DataFrame | None = None, metric: str = "unq_dst_ip", key: str = "src_ip",
                         out: str = "avg_unq_dst_ip") -> DataFrame:
    """All-time mean per key that goes on from ``initial`` (``key, total, n``, see ``read_state``).

    The partition count of a stateful query is fixed for the life of its checkpoint; to
    change it, stop the query and start this one on a new checkpoint with the old one's
    sums.  Emits the changed keys of each trigger (update mode).  Records are summed in
    the partition they arrive in before they meet the state.
    """
    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.groupby(key, dropna=False, as_index=False).agg(total=("total", "sum"), n=("n", "sum"))

    rows = logs.select(key, F.col(metric).cast("double").alias("total"), F.col(metric).isNotNull().cast("long").alias("n"))
    schema = T.StructType([T.StructField(key, rows.schema[key].dataType), T.StructField(out, T.DoubleType())])
    start = initial.select(key, "total", "n").groupBy(key) if initial is not None else None
    return rows.mapInPandas(combine, rows.schema).groupBy(key).transformWithStateInPandas(
        _Average(schema), schema, "update", "none", initialState=start)
