"""Row-wise rolling time frames on a stream: keyed state, event-time timers, eviction."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tabloom.operators.timeseries import period_micros

PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FUNCTIONS = ("max", "min", "sum", "count", "avg")


def frame_values(us: np.ndarray, value: np.ndarray, at: np.ndarray, period: int, fn: str) -> np.ndarray:
    """``fn`` over the readings in (t - period, t] for every time in ``at``; ``us`` is sorted, nulls (NaN) count for nothing.

    A frame without a value gives NaN (a count 0). Largest and smallest values come from a table of power-of-two runs, so that their cost does
    not depend on the readings of a frame; sums are added up per frame, which keeps them exact to their own size.
    """
    known = ~np.isnan(value)
    us, value = us[known], value[known]
    lo, hi = np.searchsorted(us, at - period, "right"), np.searchsorted(us, at, "right")
    n = hi - lo
    if fn == "count":
        return n.astype(float)
    out = np.full(len(at), np.nan)
    some = n > 0
    if not some.any():
        return out
    lo, hi, n = lo[some], hi[some], n[some]
    if fn in ("sum", "avg"):
        total = np.array([value[a:b].sum() for a, b in zip(lo, hi)])
        out[some] = total / n if fn == "avg" else total
        return out
    pick = np.maximum if fn == "max" else np.minimum
    runs, width = [value], 1
    while 2 * width <= n.max():
        runs.append(pick(runs[-1][:-width], runs[-1][width:]))
        width *= 2
    level = np.frexp(n.astype(float))[1] - 1
    for k, run in enumerate(runs):
        at_level = level == k
        first, last = run[lo[at_level]], run[hi[at_level] - (1 << k)]
        out[np.flatnonzero(some)[at_level]] = pick(first, last)
    return out


def _as_text(df: DataFrame, key: str) -> Column:
    """A key as text that gives the same key again; null stays null. (A batch of whole numbers with a null would come as floating ones.)"""
    kind = df.schema[key].dataType
    if not isinstance(kind, T.AtomicType):
        raise ValueError("keys are columns of plain types")
    if isinstance(kind, T.BinaryType):
        return F.hex(key)
    return (F.unix_micros(key) if isinstance(kind, T.TimestampType) else F.col(key)).cast("string")


def _from_text(kind: T.DataType, key: str) -> Column:
    if isinstance(kind, T.BinaryType):
        return F.unhex(key)
    return F.timestamp_micros(F.col(key).cast("long")) if isinstance(kind, T.TimestampType) else F.col(key).cast(kind)


class RollingProcessor(StatefulProcessor):
    """Holds the readings of one period of the keys of a bucket, as packed tables. A reading is answered when the watermark has passed its time, as no
    earlier one can come any more, and leaves the state when no later frame can reach it. All keys of a bucket take their steps together."""

    def __init__(self, period: int, fn: str, keys: Sequence[str], seq: str, ts: str, name: str):
        self.period, self.fn, self.keys, self.seq, self.ts, self.name = period, fn, list(keys), seq, ts, name

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.readings = handle.getListState("readings", "packed binary")
        self.timer = handle.getValueState("timer", "at long")

    def close(self) -> None:
        pass

    def _wake(self, ms: int) -> None:
        """One timer per bucket: the next time at which a reading can be answered or leave."""
        if self.timer.exists():
            old = self.timer.get()[0]
            if old <= ms:
                return
            self.handle.deleteTimer(old)
        self.handle.registerTimer(ms)
        self.timer.update((ms,))

    def _packed(self, keys: list[pa.Array], us: np.ndarray, seq: pa.Array, value: np.ndarray, open_: np.ndarray) -> tuple[bytes]:
        columns = [*keys, pa.array(us, pa.int64()), seq, pa.array(value, pa.float64()), pa.array(open_, pa.bool_())]
        batch = pa.RecordBatch.from_arrays(columns, names=[str(i) for i in range(len(columns))])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as out:
            out.write_batch(batch)
        return (sink.getvalue().to_pybytes(),)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first, packed = None, []
        for batch in rows:
            if len(batch):
                us, value = batch["reading_us"].to_numpy(np.int64), batch["reading_value"].to_numpy(float)
                keys = [pa.array(batch[f"reading_key_{i}"], pa.string(), from_pandas=True) for i in range(len(self.keys))]
                seq = pa.array(batch["reading_seq"], pa.string(), from_pandas=True).cast(pa.int64())
                packed.append(self._packed(keys, us, seq, value, np.ones(len(us), bool)))
                first = int(us.min()) if first is None else min(first, int(us.min()))
        if first is not None:
            self.readings.appendList(packed)
            self._wake(first // 1000 + 1)
        return iter([])

    def _rolled(self, code: np.ndarray, us: np.ndarray, value: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The frames' values of the readings ``at``, all keys on one line of time: they follow each other with more than a period between them."""
        start = us.min()
        width = int(us.max() - start) + self.period + 1
        if (int(code[-1]) + 1) * width < 1 << 62:
            line = code * width + (us - start)
            return frame_values(line, value, line[at], self.period, self.fn)
        out = np.empty(len(at))
        for c in np.unique(code[at]):
            own, asked = code == c, code[at] == c
            out[asked] = frame_values(us[own], value[own], us[at][asked], self.period, self.fn)
        return out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.timer.clear()
        done = timerValues.getCurrentWatermarkInMs() * 1000
        held = pa.concat_tables([pa.ipc.open_stream(r[0]).read_all() for r in self.readings.get()]).combine_chunks()
        k = len(self.keys)
        code = np.zeros(held.num_rows, np.int64)
        for i in range(k):
            own, names = pd.factorize(held.column(i).to_pandas(), use_na_sentinel=False)
            code = pd.factorize(code * len(names) + own)[0].astype(np.int64)
        us = held.column(k).to_numpy()
        order = np.lexsort((us, code))
        code, us, held = code[order], us[order], held.take(order)
        value, unanswered = held.column(k + 2).to_numpy(), held.column(k + 3).to_numpy()
        ready = unanswered & (us < done)
        late = unanswered & (us >= done)
        kept = np.flatnonzero((us > done - self.period) | late)
        if len(kept):
            left = held.take(kept)
            self.readings.put([self._packed([left.column(i).combine_chunks() for i in range(k)], us[kept], left.column(k + 1).combine_chunks(), value[kept], late[kept])])
            waits = np.where(late[kept], us[kept], us[kept] + self.period) // 1000 + 1
            self._wake(max(int(waits.min()), done // 1000 + 1))
        else:
            self.readings.clear()
        at = np.flatnonzero(ready)
        if len(at):
            rolled, answered = self._rolled(code, us, value, at), held.take(at)
            out = {name: answered.column(i).to_pandas() for i, name in enumerate(self.keys)}
            out[self.seq] = answered.column(k + 1).cast(pa.string()).to_pandas()
            out[self.ts] = pd.to_datetime(us[at], unit="us")
            out[self.name] = rolled
            yield pd.DataFrame(out)


#: Groups of keys that share their state. More of them make each smaller; every one costs a few calls per trigger.
BUCKETS = 1024


def stream_rolling(df: DataFrame, keys: Sequence[str], ts: str, period: str, c: str, seq: str, fn: str = "max", delay: str = "1 hour",
                   name: str = "rolled", buckets: int = BUCKETS) -> DataFrame:
    """(keys, ``seq``, ``ts``, ``name``): for each reading the aggregate of its key over the last ``period`` up to it, ties included.

    The same frame as the batch job's, row by row. Readings may come late by ``delay``; one is answered once the watermark has passed it. State
    per key is the readings of the period and the delay; keys are dealt by hash to ``buckets``, and those of a bucket are handled in one call, as a
    call costs more than the readings of a key. ``seq`` (long) tells readings apart; readings without a time cannot be placed and are left
    out. Needs the RocksDB state store, which is set for the session's streams.
    """
    if fn not in FUNCTIONS:
        raise ValueError(f"one of {', '.join(FUNCTIONS)}")
    df.sparkSession.conf.set(PROVIDER_CONF, ROCKSDB)
    plain = df if df.schema[ts].dataType.simpleString() == "timestamp" else df.withColumn(ts, F.col(ts).cast("timestamp"))
    placed = plain.filter(F.col(ts).isNotNull()).withWatermark(ts, delay)
    texts = [_as_text(plain, k).alias(f"reading_key_{i}") for i, k in enumerate(keys)]
    rows = placed.select(F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("reading_bucket"), *texts, ts, F.unix_micros(ts).alias("reading_us"),
                         F.col(seq).cast("long").cast("string").alias("reading_seq"), F.col(c).cast("double").alias("reading_value"))
    schema = ", ".join([*[f"`{k}` string" for k in keys], f"`{seq}` string", f"`{ts}` timestamp_ntz", f"`{name}` double"])
    processor = RollingProcessor(period_micros(period), fn, keys, seq, ts, name)
    out = rows.groupBy("reading_bucket").transformWithStateInPandas(processor, schema, "Append", "EventTime")
    return out.select(*[_from_text(df.schema[k].dataType, k).alias(k) for k in keys], F.col(seq).cast("long").alias(seq), ts, name)
