"""The politeness gate as keyed state with event timers: requests that come too early run later, each exactly once.

State of a host: its last grant and the requests that wait. A timer of the host fires when the watermark passes the
time of its next grant; the gate then emits every request whose time has come and sets the timer for the next one. So
a request is granted at ``max(its clock, last grant + its gap)``, in the order of clock and tie, and it is emitted in the
micro-batch whose watermark passes that time. Rows may be out of order by up to ``lateness``.

A host is forgotten once the watermark is the longest honoured gap past its last grant and nothing waits, since no gap reaches
back that far; the state is bounded by the hosts that were busy lately. It lives in RocksDB, partitioned by host. One
host is one key, as its grants form one sequence. Its requests wait in sorted runs, cut into packed chunks of ``CHUNK_ROWS`` at most. A
timer reads them in the order of their first clocks and only as far as requests run, so neither a long queue nor the
number of timers makes it read everything again, and the grants of many requests are one running maximum. A request without a host is
granted at once and leaves no state.

A feed that ends needs a last row far in the future (a tick, without host), or the last requests wait for ever. Clocks must
lie before the year 2262, where time stamps in Python end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from crawlweave.streaming.feed import BatchTable, drain, schema_of

#: Longest gap that is honoured unless said otherwise: the cap on crawl delays.
LONGEST_GAP_MS = 60_000
#: Keys over which requests without a host are spread.
SPREAD = 1024
#: Rows of a packed chunk, and rows of one host and micro-batch that are sorted together. Only a matter of speed and memory.
CHUNK_ROWS, SORTED_ROWS = 8192, 262_144
_KEY, _AT = "__key", "__at"
_NULLABLE = {
    pa.int8(): pd.Int8Dtype(), pa.int16(): pd.Int16Dtype(), pa.int32(): pd.Int32Dtype(), pa.int64(): pd.Int64Dtype(), pa.bool_(): pd.BooleanDtype()
}


class _Gate(StatefulProcessor):
    """``clock``, ``gap`` and ``order`` are names of columns of ``schema``."""

    def __init__(self, schema: StructType, host: str, clock: str, gap: str, order: str, longest_ms: int):
        self.schema, self.longest = schema, longest_ms
        self.host, self.clock, self.gap, self.order = host, clock, gap, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.arrow = to_arrow_schema(self.schema, timestamp_utc=False)  # frames have clock times of the session
        self.last = handle.getValueState("last", "ms bigint")
        self.runs = handle.getValueState("runs", "next bigint, numbers binary, firsts binary")  # of each chunk: number and first clock
        self.chunks = handle.getMapState("chunks", "number bigint", "rows binary")

    def _sorted(self, parts: list[pa.Table]) -> pa.Table:
        """The rows of all parts by clock and order; equal ones as they came."""
        rows = pa.concat_tables(parts).combine_chunks()
        order = rows[self.order].combine_chunks()
        ties = order.fill_null(0).to_numpy(zero_copy_only=False)
        at = np.lexsort((ties, order.is_valid().to_numpy(zero_copy_only=False), self._clocks(rows)))
        return rows.take(pa.array(at))

    def _clocks(self, rows: pa.Table) -> np.ndarray:
        if rows[self.clock].null_count:
            raise ValueError(f"a request of a host has no {self.clock}")
        return rows[self.clock].to_numpy().astype(np.int64)

    def _times(self, rows: pa.Table, last: int | None) -> np.ndarray:
        """When sorted rows run after a last grant: the running sum of gaps plus the running maximum of clocks less that sum."""
        if rows[self.gap].null_count:
            raise ValueError(f"a request of a host has no {self.gap}")
        gaps = np.cumsum(np.clip(rows[self.gap].to_numpy().astype(np.int64), 1, self.longest))
        most = np.maximum.accumulate(self._clocks(rows) - gaps)
        return gaps + (most if last is None else np.maximum(most, last))

    def _index(self) -> tuple[int, list[tuple[int, int]]]:
        """The next number, and (first clock, number) of all chunks in ascending order."""
        if not self.runs.exists():
            return 0, []
        following, numbers, firsts = self.runs.get()
        numbers, firsts = (np.frombuffer(bytes(x), np.int64).tolist() for x in (numbers, firsts))
        return int(following), sorted(zip(firsts, numbers))

    def _keep(self, following: int, index: list[tuple[int, int]], rows: pa.Table) -> None:
        """Add sorted rows to the chunks of ``index`` and write the index."""
        for begin in range(0, rows.num_rows, CHUNK_ROWS):
            chunk = rows.slice(begin, CHUNK_ROWS).combine_chunks()
            packed = chunk.to_batches()[0].serialize().to_pybytes()
            self.chunks.updateValue((following,), (packed,))
            index = [*index, (int(chunk[self.clock][0].as_py()), following)]
            following += 1
        firsts, numbers = (np.array([x[i] for x in index], np.int64).tobytes() for i in (0, 1))
        self.runs.update((following, numbers, firsts))

    def _chunk(self, number: int) -> pa.Table:
        packed = bytes(self.chunks.getValue((number,))[0])
        return pa.Table.from_batches([pa.ipc.read_record_batch(pa.py_buffer(packed), self.arrow)])

    def _frame(self, rows: pa.Table, times) -> pd.DataFrame:
        return rows.append_column("granted_ms", pa.array(times, pa.int64())).to_pandas(types_mapper=_NULLABLE.get)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held, n, first = [], 0, None

        def keep() -> None:
            self._keep(*self._index(), self._sorted(held))
            held.clear()

        for frame in rows:
            table = pa.Table.from_pandas(frame[self.schema.names], self.arrow, preserve_index=False)
            hosted = table[self.host].is_valid()
            free, table = table.filter(pa.compute.invert(hosted)), table.filter(hosted)
            if free.num_rows:
                yield self._frame(free, free[self.clock].combine_chunks().cast(pa.int64()))
            if table.num_rows:
                least = int(self._clocks(table).min())
                first = least if first is None else min(first, least)
                held.append(table)
                n += table.num_rows
                if n >= SORTED_ROWS:
                    keep()
                    n = 0
        if held:
            keep()
        if first is not None:
            # the watermark has to pass the clock before the order of the rows up to it is known
            self.handle.registerTimer(first)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        last = int(self.last.get()[0]) if self.last.exists() else None
        following, index = self._index()
        waiting, read, granted, coming = self.arrow.empty_table(), 0, False, None
        while coming is None:
            # twice as many rows at a time as wait already, so merging stays in proportion
            parts, n = [waiting], 0
            while read < len(index) and index[read][0] <= now and n < max(CHUNK_ROWS, waiting.num_rows):
                parts.append(self._chunk(index[read][1]))
                n += parts[-1].num_rows
                read += 1
            waiting = self._sorted(parts) if n else waiting
            # rows before the next chunk begins are in their final order
            bound = index[read][0] if read < len(index) else None
            ready = waiting.num_rows if bound is None else int(np.searchsorted(self._clocks(waiting), bound, "left"))
            if ready:
                times = self._times(waiting.slice(0, ready), last)
                run = int(np.searchsorted(times, now, "right"))
                if run:
                    yield self._frame(waiting.slice(0, run), times[:run])
                    last, granted = int(times[run - 1]), True
                if run < ready:
                    coming = int(times[run])
                waiting = waiting.slice(run)
            elif not n:
                break
        if coming is None and (waiting.num_rows or read < len(index)):
            # nothing is left that has come, so the next one runs at its own clock or later
            coming = min([*(x for x, _ in index[read : read + 1]), *(self._clocks(waiting)[:1].tolist())])
        if granted:
            self.last.update((last,))
            for _, number in index[:read]:
                self.chunks.removeKey((number,))
            self._keep(following, index[read:], waiting)
        if coming is not None:
            self.handle.registerTimer(coming)
        else:
            self.runs.clear()
            self.chunks.clear()
            if last is not None and now > last + self.longest:
                self.last.clear()
            elif last is not None:
                self.handle.registerTimer(int(last + self.longest + 1))


def gate(
    feed: DataFrame, host: str, clock: str, gap: str, order: str, lateness: str = "10 minutes", longest_ms: int = LONGEST_GAP_MS
) -> DataFrame:
    """Stream of all rows of ``feed`` with ``granted_ms``, in the order of their grants by host.

    ``clock`` (milliseconds), ``gap`` (milliseconds) and ``order`` are bigints. Spark drops rows that come later than
    ``lateness`` behind the newest clock, so choose it as long as rows can be late; grants are held back by it. Gaps
    above ``longest_ms`` count as that, which is also how long an idle host is remembered. Clocks must not be null.
    """
    columns = feed.columns
    spread = F.concat(F.lit("\0"), F.pmod(F.xxhash64(order), F.lit(SPREAD)).cast("string"))
    keyed = feed.withColumns({_KEY: F.coalesce(F.col(host), spread), _AT: F.timestamp_millis(clock)})
    keyed = keyed.withWatermark(_AT, lateness)
    schema = StructType(feed.select(*columns).schema.fields)
    out = StructType([*schema.fields, StructField("granted_ms", LongType())])
    processor = _Gate(schema, host, clock, gap, order, longest_ms)
    return keyed.groupBy(_KEY).transformWithStateInPandas(processor, out, "append", "EventTime")


def gated_feed(
    feed: DataFrame, host: str, clock: str, gap: str, order: str, lateness: str = "10 minutes",
    longest_ms: int = LONGEST_GAP_MS, path: str | None = None, checkpoint: str | None = None,
) -> BatchTable:
    """The gate over what is available now, as a table partitioned by the micro-batch that granted the rows."""
    granted = gate(feed, host, clock, gap, order, lateness, longest_ms)
    sink = BatchTable(feed.sparkSession, "granted", schema_of(granted), path)
    drain(granted, sink.write, checkpoint=checkpoint)
    return sink
