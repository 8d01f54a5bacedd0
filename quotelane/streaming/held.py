"""Rows in any order, put in order before a keyed processor takes them.

A key's rows wait in a map state by buckets of time. A bucket is written in parts, one per
micro-batch that brings rows of it, and read once, when the watermark has passed its end: then no
earlier row can come. A key has one timer, at its first bucket that waits; it takes all buckets that the
watermark has passed, in order. What lies in later buckets is neither read nor written meanwhile, so a
side that runs ahead costs state in proportion to its rows.

Where results may wait for each other, as in a replay, some buckets lie ``together`` in the state, and go to
the processor at once. Of those that the watermark stands in, what is still open is written again.

What a processor makes of a bucket carries the bucket's last millisecond as event time (``ts``), as
the watermark may have passed single rows of it already; ``timestamp`` stays the row's own. Where
windows follow, their width must be a multiple of the bucket's.

A row whose bucket has closed is late. Spark drops rows behind the watermark before a processor sees
them; the ``late`` forms take the time column's mark away first, so these rows come in, and go out again as
they are with ``late`` set. Together with the rows taken they are all rows.

A keyed processor gets its rows one by one, as Python objects. So where buckets lie together, and in the ``late``
forms, rows are packed before they are shuffled: a key's rows of a task travel as one Arrow batch. Packets have
no event time, so the processor itself leaves out rows of buckets that it has given out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, StructField, StructType

from quotelane.operators.conflation import PERIOD_MS
from quotelane.streaming import keyed

BUCKET_MS = 10_000
# Rows of a key that are gathered before they are cut by stretches, so that a stretch is written in few parts.
GATHERED = 100_000
# Rows of a task that are gathered before they are packed by keys.
PACKED = 100_000
# Arrival orders: of rows that are numbered, and of messages, which get numbers as they are released.
NUMBERED = "ord BIGINT"
MESSAGES = "kind STRING, partition INT, offset BIGINT"
_WHOLE = {"BIGINT", "INT"}
_ARROW = {"BIGINT": pa.int64(), "INT": pa.int32(), "DOUBLE": pa.float64(), "STRING": pa.string(), "BOOLEAN": pa.bool_()}


def _kinds(columns: str, order: str) -> dict[str, str]:
    fields = {"timestamp": "BIGINT"}
    for part in f"{order}, {columns}".split(","):
        name, kind = part.split()
        fields[name] = kind
    return fields


def _arrow(kinds: dict[str, str]) -> pa.Schema:
    return pa.schema([(c, _ARROW[kind]) for c, kind in kinds.items()])


def packer(keys: Sequence[str], schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow``: rows of a key, in columns ``_k0`` and on, as packets of at most ``keyed.CHUNK`` rows."""
    places = [f"_k{i}" for i in range(len(keys))]

    def packets(waiting: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(waiting).combine_chunks()
        group = np.zeros(len(table), dtype=np.int64)
        for place in places:
            codes = pc.dictionary_encode(table[place].combine_chunks(), null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            # numbered anew at each key, so that they stay below the number of rows
            group = np.unique(group * (int(codes.max()) + 1) + codes, return_inverse=True)[1]
        order = group.argsort(kind="stable")
        starts = np.unique(group[order], return_index=True)[1]
        rows = table.select(schema.names).cast(schema).take(order).combine_chunks()
        cut = [(int(a), int(b)) for a, b in zip(starts, [*starts[1:], len(order)], strict=True)]
        cut = [(a, min(keyed.CHUNK, end - a)) for start, end in cut for a in range(start, end, keyed.CHUNK)]
        firsts = pa.array(order[[a for a, _ in cut]])
        made = [rows.slice(a, n).to_batches()[0].serialize().to_pybytes() for a, n in cut]
        columns = [table[place].combine_chunks().take(firsts) for place in places]
        return pa.RecordBatch.from_arrays([*columns, pa.array(made, pa.binary())], [*keys, "rows"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                size += batch.num_rows
            if size >= PACKED:
                yield packets(waiting)
                waiting, size = [], 0
        if waiting:
            yield packets(waiting)

    return pack


def _packed(events: DataFrame, keys: Sequence[str], columns: str, order: str) -> DataFrame:
    kinds = _kinds(columns, order)
    given = events.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[F.col(c).cast(kind).alias(c) for c, kind in kinds.items()]
    )
    schema = StructType([*[StructField(k, events.schema[k].dataType) for k in keys], StructField("rows", BinaryType())])
    return given.mapInArrow(packer(keys, _arrow(kinds)), schema)


class Held(StatefulProcessor):
    """``inner`` takes the rows of a bucket by ``ordered``; where it has a time that it is ``due`` at, it is told
    by ``passed`` once all rows before that are in."""

    def __init__(
        self,
        inner: StatefulProcessor,
        columns: str,
        order: str,
        bucket_ms: int = BUCKET_MS,
        late: tuple[list[str], list[str]] | None = None,
        together: int = 1,
        packed: bool = False,
    ) -> None:
        """``late``: names of the key and of all columns that go out, where late rows go out too. ``packed``: rows
        come in packets (``packer``)."""
        fields = _kinds(columns, order)
        self.inner = inner
        self.packed = packed
        self.late = late
        self.columns = list(fields)
        self.whole = {c for c, kind in fields.items() if kind in _WHOLE}
        self.schema = _arrow(fields)
        self.order = ["timestamp", *keyed._names(order)]
        self.numbers = order == MESSAGES
        self.bucket_ms = bucket_ms
        self.together = together

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.inner.init(handle)
        if hasattr(self.inner, "wait_until"):
            # fires are due once all rows before them are in, which the key's own timer tells
            self.inner.wait_until = lambda deadline: None
            self.inner.wait_no_more = lambda deadline: None
        # of buckets that lie together: how many parts, and the first bucket in them
        self.parts = handle.getMapState("parts", "stretch BIGINT", "parts BIGINT, first BIGINT")
        self.rows = handle.getMapState("rows", "stretch BIGINT, part BIGINT", "rows BINARY")
        self.taken = handle.getValueState("taken", "taken BIGINT")
        self.woken = handle.getValueState("woken", "bucket BIGINT")
        # the last bucket that is given out, where Spark does not drop the rows that come after
        self.given = handle.getValueState("given", "bucket BIGINT") if self.packed and not self.late else None

    def _bucket(self, at: int) -> int:
        return at // self.bucket_ms

    def _end(self, bucket: int) -> int:
        return (bucket + 1) * self.bucket_ms - 1

    def _wake(self, bucket: int) -> None:
        self.handle.registerTimer(self._end(bucket))

    def _plain(self, frame: pd.DataFrame) -> list[tuple]:
        columns = []
        for c in self.columns:
            values = frame[c].astype(object).where(frame[c].notna(), None).tolist()
            columns.append([None if v is None else int(v) for v in values] if c in self.whole else values)
        return list(zip(*columns, strict=True))

    def _keep(self, stretch: int, number: int, rows: pa.Table) -> int:
        """Write rows as parts from ``number`` on; the number after the last."""
        for batch in rows.to_batches(keyed.CHUNK):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, self.schema) as stream:
                stream.write_batch(batch)
            self.rows.updateValue((stretch, number), (sink.getvalue().to_pybytes(),))
            number += 1
        return number

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        clock = timerValues.getCurrentWatermarkInMs()
        found: dict[int, tuple[int, int]] = {}
        waiting, size = [], 0
        given = self.given.get()[0] if self.given is not None and self.given.exists() else None
        for table in self._tables(rows):
            if self.late:
                at = table["timestamp"].to_pandas()
                closed = ((at // self.bucket_ms + 1) * self.bucket_ms - 1 < clock).to_numpy()
                if closed.any():
                    yield self._late(key, table.filter(pa.array(closed)).to_pandas())
                    table = table.filter(pa.array(~closed))
            # a row without time has no bucket
            table = table.filter(pc.is_valid(table["timestamp"]))
            if given is not None:
                table = table.filter(pc.greater(table["timestamp"], self._end(given)))
            waiting.append(table)
            size += len(table)
            if size >= GATHERED:
                self._hold(waiting, found)
                waiting, size = [], 0
        self._hold(waiting, found)
        for place, held in found.items():
            self.parts.updateValue((place,), held)
        if found:
            first = min(lowest for _, lowest in found.values())
            if not self.woken.exists() or first < self.woken.get()[0]:
                self.woken.update((first,))
                self._wake(first)

    def _tables(self, frames: Iterator[pd.DataFrame]) -> Iterator[pa.Table]:
        for frame in frames:
            if not self.packed:
                yield pa.Table.from_pandas(frame, self.schema, preserve_index=False)
                continue
            for rows in frame["rows"]:
                yield pa.Table.from_batches([pa.ipc.read_record_batch(pa.py_buffer(rows), self.schema)])

    def _hold(self, tables: list[pa.Table], found: dict[int, tuple[int, int]]) -> None:
        """Write rows to their stretches; ``found`` has the number of parts and the first bucket of those met so far."""
        rows = pa.concat_tables([self.schema.empty_table(), *tables]).combine_chunks()
        if not len(rows):
            return
        at = rows["timestamp"].to_numpy()
        order = (at // (self.bucket_ms * self.together)).argsort(kind="stable")
        rows, at = rows.take(order), at[order]
        stretches, starts = np.unique(at // (self.bucket_ms * self.together), return_index=True)
        for place, start, end in zip(stretches.tolist(), starts, [*starts[1:], len(at)], strict=True):
            first = self._bucket(int(at[start:end].min()))
            if place not in found:
                known = self.parts.containsKey((place,))
                found[place] = tuple(self.parts.getValue((place,))) if known else (0, first)
            number, lowest = found[place]
            found[place] = self._keep(place, number, rows.slice(start, end - start)), min(lowest, first)

    def _late(self, key, rows: pd.DataFrame) -> pd.DataFrame:
        names, columns = self.late
        out = pd.DataFrame(self._plain(rows), columns=self.columns)
        out["ts"] = pd.to_datetime(out["timestamp"], unit="ms")
        out = self._shaped(out.assign(**dict(zip(names, key, strict=True)), late=True))
        if "quantity" in columns:
            out["quantity"] = out["quantity"].astype("Int32")
        return out

    def _shaped(self, frame: pd.DataFrame) -> pd.DataFrame:
        columns = self.late[1]
        return frame.assign(**{c: None for c in columns if c not in frame.columns})[columns]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        # the last bucket that is over
        closed = max(timerValues.getCurrentWatermarkInMs() // self.bucket_ms - 1, self._bucket(at))
        left = []
        for (stretch,), (parts, first) in sorted((tuple(k), tuple(v)) for k, v in self.parts.iterator()):
            if first > closed:
                left.append(first)
                continue
            batch, after = self._take(stretch, parts, closed)
            if after is not None:
                left.append(after)
            if self.numbers:
                number = self.taken.get()[0] if self.taken.exists() else 0
                self.taken.update((number + len(batch),))
                batch["ord"] = range(number, number + len(batch))
            batch["ts"] = pd.to_datetime(batch["timestamp"], unit="ms")
            for frame in self.inner.ordered(key, batch):
                yield self._made(frame, at)
        if self.given is not None:
            self.given.update((closed,))
        due = self.inner.due() if hasattr(self.inner, "due") else None
        if due is not None:
            # no bucket before it waits once its own is over
            last = self._bucket(due - 1)
            if last > closed:
                left.append(last)
            else:
                for frame in self.inner.passed(key):
                    yield self._made(frame, at)
        if left:
            self.woken.update((min(left),))
            self._wake(min(left))
        else:
            self.woken.clear()

    def _take(self, stretch: int, parts: int, closed: int) -> tuple[pd.DataFrame, int | None]:
        """The rows of a stretch up to a bucket, in order, and the first bucket of it that is left."""
        waiting = []
        for number in range(parts):
            with pa.ipc.open_stream(bytes(self.rows.getValue((stretch, number))[0])) as stream:
                waiting.append(stream.read_all())
            self.rows.removeKey((stretch, number))
        table = pa.concat_tables(waiting)
        batch = table.to_pandas()
        for c in self.whole:
            if table[c].null_count and table[c].type == pa.int64():  # as doubles they would lose digits
                batch[c] = table[c].to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)
        later = batch["timestamp"] // self.bucket_ms > closed
        if later.any():
            after = self._bucket(int(batch.loc[later, "timestamp"].min()))
            kept = self._keep(stretch, 0, table.filter(pa.array(later)).combine_chunks())
            self.parts.updateValue((stretch,), (kept, after))
            batch = batch[~later]
        else:
            after = None
            self.parts.removeKey((stretch,))
        return batch.sort_values(self.order, ignore_index=True), after

    def _made(self, frame: pd.DataFrame, at: int) -> pd.DataFrame:
        if self.late:
            return self._shaped(frame.assign(late=False))
        ends = ((frame["timestamp"] // self.bucket_ms + 1) * self.bucket_ms - 1).clip(lower=at)
        return frame.assign(ts=pd.to_datetime(ends.astype("int64"), unit="ms"))


class Passing:
    """Rows as they are, in order."""

    def __init__(self, names: list[str]) -> None:
        self.names = names

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def ordered(self, key, batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
        out = batch.assign(**dict(zip(self.names, key, strict=True)))
        if "quantity" in out.columns:
            out["quantity"] = out["quantity"].astype("Int32")
        yield out


def run(
    events: DataFrame, keys: Sequence[str], inner: StatefulProcessor, columns: str, order: str, schema: str, bucket_ms: int,
    together: int = 1,
) -> DataFrame:
    """``inner`` on rows put in order; where buckets lie together, rows come in packets."""
    packed = together > 1
    given = _packed(events, keys, columns, order) if packed else events
    return given.groupBy(*keys).transformWithStateInPandas(
        Held(inner, columns, order, bucket_ms, together=together, packed=packed), schema, "append", "eventTime", eventTimeColumnName="ts"
    )


def _run_with_late(
    events: DataFrame, keys: Sequence[str], inner: StatefulProcessor, columns: str, order: str, schema: str, bucket_ms: int,
    together: int = 1,
) -> DataFrame:
    """As ``run``, with late rows; the result has no watermark, as they are older than it."""
    late = (list(keys), [*keyed._names(schema), "late"])
    return _packed(events, keys, columns, order).groupBy(*keys).transformWithStateInPandas(
        Held(inner, columns, order, bucket_ms, late, together, packed=True), f"{schema}, late BOOLEAN", "append", "eventTime"
    )


def in_order(
    events: DataFrame, columns: str, order: str = MESSAGES, bucket_ms: int = BUCKET_MS, together: int = 1
) -> DataFrame:
    """Every row of a security once: in order and numbered (``ord``), or late and without number."""
    fields = {part.split()[0]: part for part in f"cusip STRING,{columns},{order},ord BIGINT,timestamp BIGINT,ts TIMESTAMP".split(",")}
    schema = ", ".join(part.strip() for part in fields.values())
    return _run_with_late(events, ["cusip"], Passing(["cusip"]), columns, order, schema, bucket_ms, together)


def price_single_slot_with_late(
    events: DataFrame, slot: str = keyed.ACCOUNT_SLOT, order: str = MESSAGES, bucket_ms: int = BUCKET_MS
) -> DataFrame:
    """``price_single_slot`` whose late rows go out too, with ``late`` set, ``kind``, and no ``ord``."""
    columns = f"kind STRING, price DOUBLE, {slot}"
    schema = f"{keyed.priced_schema(slot)}, kind STRING"
    return _run_with_late(events, ["cusip"], keyed.SingleSlot(slot), columns, order, schema, bucket_ms)


def price_single_slot(
    events: DataFrame,
    slot: str = keyed.ACCOUNT_SLOT,
    order: str = MESSAGES,
    bucket_ms: int = BUCKET_MS,
    together: int = 1,
) -> DataFrame:
    """Single-slot pricing of rows in any order; events carry a watermark on ``ts``.

    Messages have ``partition`` and ``offset`` in place of ``ord``; the result's ``ord`` numbers a
    security's rows.
    """
    columns = f"kind STRING, price DOUBLE, {slot}"
    return run(events, ["cusip"], keyed.SingleSlot(slot), columns, order, keyed.priced_schema(slot), bucket_ms, together)


def price_list_buffer(
    events: DataFrame,
    slot: str = keyed.ACCOUNT_SLOT,
    order: str = MESSAGES,
    bucket_ms: int = BUCKET_MS,
    together: int = 1,
) -> DataFrame:
    """Every position waits for its security's next price, rows in any order."""
    columns = f"kind STRING, price DOUBLE, {slot}"
    return run(events, ["cusip"], keyed.ListBuffer(slot), columns, order, keyed.listed_schema(slot), bucket_ms, together)


def price_timer_conflation(
    events: DataFrame, period_ms: int = PERIOD_MS, order: str = MESSAGES, bucket_ms: int = BUCKET_MS, together: int = 1
) -> DataFrame:
    """The latest position of every account slot at each fire of the security's timer, rows in any order.

    A fire goes out once the watermark has passed its bucket.
    """
    columns = f"kind STRING, price DOUBLE, {keyed.ACCOUNT_SLOT}"
    return run(events, ["cusip"], keyed.TimerConflation(period_ms), columns, order, keyed.CONFLATED, bucket_ms, together)


def rolling_quantity(
    positions: DataFrame, order: str = MESSAGES, bucket_ms: int = BUCKET_MS, together: int = 1
) -> DataFrame:
    """Running totals by account and security, rows in any order."""
    keys = ["account", "subAccount", "cusip"]
    columns = "account STRING, subAccount STRING, cusip STRING, quantity INT"
    return run(positions, keys, keyed.RollingTotal(), columns, order, keyed.ROLLED, bucket_ms, together)
