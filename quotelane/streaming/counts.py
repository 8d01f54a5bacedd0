"""Word counts of windows that lie together in the state.

By rows, a state holds every word of every window with its whole key, and writes it twice: once as it comes and once as it
goes, several times the text in all. Here a task counts its words first and sends what it has of a stretch of windows as
packets, in which a word stands once. A stretch's packets are written once, and read once when the watermark has passed its end.

Words are dealt over slots, so that a stretch with most of the words goes to several tasks. A task holds as many
counts as a stretch and slot have different words and windows, however often they come.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Rows, and bytes, that are gathered before they are counted.
GATHERED = 1 << 18
GATHERED_BYTES = 16 << 20
# Rows given out at a time.
CHUNK = 100_000
SLOTS = 8
COUNTED = "windowStart BIGINT, windowEnd BIGINT, word STRING, count BIGINT"
# Of a packet: how long a word is, in how many places it stands, the places and the counts there.
_KINDS = ("<i4", "<i4", "<u2", "<i8")
_LEVEL = 3


class Tally(NamedTuple):
    """Counts of words by windows' starts, each pair once, in order of the word and then the start."""

    words: pa.Array
    starts: np.ndarray
    word: np.ndarray
    start: np.ndarray
    count: np.ndarray


def _ranked(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The different values in order, and the place of each value among them."""
    coded = pc.dictionary_encode(values)
    order = pc.sort_indices(coded.dictionary).to_numpy()
    places = np.empty(len(order), dtype=np.int64)
    places[order] = np.arange(len(order))
    return coded.dictionary.take(pa.array(order)), places[coded.indices.to_numpy()]


def _tally(rows: list[pa.Table]) -> Tally:
    """Of rows ``start``, ``word`` and ``count``."""
    table = pa.concat_tables(rows).combine_chunks()
    words, word = _ranked(table["word"].combine_chunks())
    starts, start = _ranked(table["start"].combine_chunks())
    pair = word * len(starts) + start
    order = pair.argsort()
    pair = pair[order]
    firsts = np.flatnonzero(np.diff(pair, prepend=-1))
    pair, count = pair[firsts], np.add.reduceat(table["count"].to_numpy()[order], firsts)
    return Tally(words, starts.to_numpy(), pair // len(starts), pair % len(starts), count)


def _rows(tally: Tally) -> pa.Table:
    columns = [tally.starts[tally.start], tally.words.take(pa.array(tally.word)), tally.count]
    return pa.table(columns, names=["start", "word", "count"])


class _Gathered:
    """Rows that are counted as they come, each time there are twice as many as are left of the last time."""

    def __init__(self) -> None:
        self._start([], GATHERED, GATHERED_BYTES)

    def _start(self, rows: list[pa.Table], most: int, most_bytes: int) -> None:
        self.rows, self.most, self.most_bytes = rows, most, most_bytes
        self.size = sum(map(len, rows))
        self.bytes = sum(r.nbytes for r in rows)

    def add(self, rows: pa.Table) -> bool:
        """Whether counting has left many: waiting for more would not make them fewer."""
        self.rows.append(rows)
        self.size += len(rows)
        self.bytes += rows.nbytes
        if self.size < self.most and self.bytes < self.most_bytes:
            return False
        left = _rows(_tally(self.rows))
        self._start([left], max(GATHERED, 2 * len(left)), max(GATHERED_BYTES, 2 * left.nbytes))
        return 2 * len(left) > GATHERED or 2 * left.nbytes > GATHERED_BYTES

    def take(self) -> Tally:
        made = _tally(self.rows)
        self._start([], GATHERED, GATHERED_BYTES)
        return made


def _packed(words: pa.Array, word: np.ndarray, place: np.ndarray, count: np.ndarray) -> bytes:
    """A word stands once, then how many places it has. Lengths shrink under compression, offsets would not."""
    firsts = np.flatnonzero(np.diff(word, prepend=-1))
    texts = words.take(pa.array(word[firsts])).cast(pa.binary()).to_pylist()
    columns = [np.array([len(t) for t in texts]), np.diff([*firsts, len(word)]), place, count]
    plain = b"".join([*[c.astype(kind).tobytes() for c, kind in zip(columns, _KINDS, strict=True)], *texts])
    return b"".join([np.array([len(firsts), len(word), len(plain)], dtype="<i8").tobytes(), pa.Codec("zstd", _LEVEL).compress(plain, asbytes=True)])


def _unpacked(packet: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Word, place and count of each pair."""
    texts, pairs, size = np.frombuffer(packet, "<i8", 3).tolist()
    plain = pa.Codec("zstd").decompress(packet[24:], size, asbytes=True)
    columns, at = [], 0
    for kind, n in zip(_KINDS, [texts, texts, pairs, pairs], strict=True):
        columns.append(np.frombuffer(plain, kind, n, at))
        at += columns[-1].nbytes
    lengths, runs, place, count = columns
    offsets = np.zeros(texts + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    words = pa.StringArray.from_buffers(texts, pa.py_buffer(offsets), pa.py_buffer(plain[at:]))
    return words.take(pa.array(np.repeat(np.arange(texts), runs))), place, count


def counter(width_ms: int, together: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow``: rows ``start`` and ``word`` as packets of counts by ``stretch`` and ``slot``."""

    def packets(tally: Tally) -> pa.RecordBatch:
        stretches, stretch = np.unique(tally.starts // (width_ms * together), return_inverse=True)
        slots = np.array([zlib.crc32(w) % SLOTS for w in tally.words.cast(pa.binary()).to_pylist()])
        place = tally.starts // width_ms % together
        group = stretch[tally.start] * SLOTS + slots[tally.word]
        order = group.argsort(kind="stable")
        groups, firsts = np.unique(group[order], return_index=True)
        made = []
        for first, end in zip(firsts, [*firsts[1:], len(order)], strict=True):
            at = order[first:end]
            made.append(_packed(tally.words, tally.word[at], place[tally.start[at]], tally.count[at]))
        columns = [stretches[groups // SLOTS] * (width_ms * together), (groups % SLOTS).astype(np.int32), pa.array(made, pa.binary())]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["stretch", "slot", "rows"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered = _Gathered()
        for batch in batches:
            if batch.num_rows:
                ones = pa.array(np.ones(batch.num_rows, dtype=np.int64))
                if gathered.add(pa.Table.from_batches([batch]).append_column("count", ones)):
                    yield packets(gathered.take())
        if gathered.size:
            yield packets(gathered.take())

    return count


class Stretch(StatefulProcessor):
    """A slot of a stretch. What comes once the watermark has passed the stretch's end is late and left out, as the
    counts are given out then."""

    def __init__(self, width_ms: int, together: int) -> None:
        self.width_ms = width_ms
        self.together = together

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.parts = handle.getValueState("parts", "parts BIGINT")
        self.rows = handle.getMapState("rows", "part BIGINT", "rows BINARY")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last = int(key[0]) + self.width_ms * self.together - 1
        if last < timerValues.getCurrentWatermarkInMs():
            return iter(())
        known = self.parts.get() if self.parts.exists() else None
        number = known[0] if known else 0
        if not number:
            self.handle.registerTimer(last)
        for frame in rows:
            for packet in frame["rows"]:
                self.rows.updateValue((number,), (bytes(packet),))
                number += 1
        self.parts.update((number,))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        gathered = _Gathered()
        for _, (packet,) in self.rows.iterator():
            gathered.add(self._table(int(key[0]), bytes(packet)))
        self.rows.clear()
        self.parts.clear()
        tally = gathered.take()
        order = tally.start.argsort(kind="stable")
        for first in range(0, len(order), CHUNK):
            at = order[first : first + CHUNK]
            start = tally.starts[tally.start[at]]
            # as Arrow's strings, which are not made Python's on their way out
            word = pd.arrays.ArrowExtensionArray(tally.words.take(pa.array(tally.word[at])))
            yield pd.DataFrame({"windowStart": start, "windowEnd": start + self.width_ms, "word": word, "count": tally.count[at]})

    def _table(self, stretch: int, packet: bytes) -> pa.Table:
        word, place, count = _unpacked(packet)
        return pa.table([stretch + place.astype(np.int64) * self.width_ms, word, count], names=["start", "word", "count"])


def word_count(words: DataFrame, start: str, width_ms: int, together: int) -> DataFrame:
    """Counts of ``word`` by windows of a width, whose start (ms) is in a column; ``together`` windows are given out at once."""
    if not 1 <= together <= 1 << 16:
        raise ValueError("from 1 to 65536 windows lie together")
    counted = words.select(F.col(start).alias("start"), "word").mapInArrow(
        counter(width_ms, together), "stretch BIGINT, slot INT, rows BINARY"
    )
    return counted.groupBy("stretch", "slot").transformWithStateInPandas(Stretch(width_ms, together), COUNTED, "append", "eventTime")
