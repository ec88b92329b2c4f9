"""Rows held back until enough of them or enough time has come together.

Each worker of the intake holds a buffer; it is given up when it has ``rows`` rows or when its
first row has waited ``seconds``, whichever comes first.  Buffers are state of the stream, so a
restart goes on with what they held, and timers that fell due meanwhile fire in the first batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

FLUSH_ROWS = 20
FLUSH_SECONDS = 10
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class FlushSpec:
    """``rows`` and ``seconds`` that end a buffer; ``buffers``: how many there are, side by side."""

    rows: int = FLUSH_ROWS
    seconds: float = FLUSH_SECONDS
    buffers: int = 32


def _flush_schema(rows: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("buffer", T.IntegerType()), T.StructField("flush", T.LongType()),
        T.StructField("cause", T.StringType()), *rows.fields])


class _Buffer(StatefulProcessor):
    """One buffer: its rows, the number of its next flush, and a timer while it holds any."""

    def __init__(self, spec: FlushSpec, schema: T.StructType):
        self.spec, self.schema = spec, schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", self.schema)
        self.counter = handle.getValueState("counter", "flush long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        names = self.schema.names
        held = [tuple(r) for r in self.held.get()]
        waiting = bool(held)
        for frame in rows:
            for row in frame[names].astype(object).itertuples(index=False, name=None):
                held.append(tuple(None if _missing(v) else v for v in row))
                if len(held) >= self.spec.rows:
                    yield self._flush(key, held, "rows")
                    self._stop_timers()
                    held, waiting = [], False
        if held:
            self.held.put([_as_stored(r) for r in held])
            if not waiting:
                now = timerValues.getCurrentProcessingTimeInMs()
                self.handle.registerTimer(now + int(self.spec.seconds * 1000))
        else:
            self.held.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = [tuple(r) for r in self.held.get()]
        if held:
            yield self._flush(key, held, "time")
            self.held.clear()

    def _stop_timers(self) -> None:
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)

    def _flush(self, key, held: list[tuple], cause: str) -> pd.DataFrame:
        number = self.counter.get()[0] if self.counter.exists() else 0
        self.counter.update((number + 1,))
        out = pd.DataFrame(held, columns=self.schema.names, dtype=object)
        for place, (name, value) in enumerate((("buffer", int(key[0])), ("flush", number),
                                               ("cause", cause))):
            out.insert(place, name, value)
        return out

    def close(self) -> None:
        pass


def _missing(value) -> bool:
    return value is None or value is pd.NaT or (isinstance(value, float) and value != value)


def _as_stored(row: tuple) -> tuple:
    return tuple(v.to_pydatetime() if isinstance(v, pd.Timestamp) else v for v in row)


def buffered(stream: DataFrame, key: Column, spec: FlushSpec = FlushSpec()) -> DataFrame:
    """``buffer, flush, cause`` (``rows`` or ``time``) and the columns of ``stream``, row by row as
    buffers are given up.

    Rows of one ``key`` share a buffer and keep the order in which they come.  A buffer never holds
    more than ``rows`` rows.  The session must use the RocksDB state store (``PROVIDER``).
    """
    schema = stream.schema
    # never NULL, so that the state's key has one schema in every run
    number = F.coalesce(F.pmod(F.xxhash64(key), F.lit(spec.buffers)).cast("int"), F.lit(0))
    return stream.withColumn("_buffer", number).groupBy("_buffer").transformWithStateInPandas(
        _Buffer(spec, schema), _flush_schema(schema), "Append", "processingTime")
