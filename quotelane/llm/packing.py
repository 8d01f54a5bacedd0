"""Pack documents into training sequences by order-preserving dynamic programming.

The token stream of each partition is cut into windows of at most ``length`` tokens. Cuts are made
at ends of documents or sentences; where none lies within a window's reach, after ``length`` tokens.
The cuts minimise the sum, over windows, of padding (none for a power of two), a penalty for cutting
a sentence or a document, and a fixed cost of a window. Since a window's padding is linear in its
start, the best start is the least of (cost + position) over the last ``length`` positions: a
monotone queue. Long streams are solved in blocks; the last window of a block goes to the next.
The rest of a partition becomes windows of powers of two, so it needs no padding.

Defined cases: a null text is empty and has the end token alone; every token lies in one piece;
rows keep their order, repeated rows are packed as often as they come; an empty table gives no
piece; other columns are ignored.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelane.llm.common import worker_state
from quotelane.llm.tokens import VOCABULARY, encoder

LENGTH = 1024
BLOCK = 1 << 18
SENTENCE_CUT = 4.0  # penalties, in tokens of padding
FORCED_CUT = 64.0
WINDOW = 128.0
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def cut_windows(
    places: np.ndarray, penalty: np.ndarray, length: int, window: float = WINDOW, shortest: int | None = None
) -> list[int]:
    """Cheapest cuts of a stream from 0 to the last place; ``places`` rise, in steps of at most ``length``.

    Powers of two from ``shortest`` on need no padding; the packer takes all, the default those from a quarter of ``length``.
    """
    at = [0, *places.tolist()]
    price = [0.0, *penalty.tolist()]
    n = len(at)
    cost, come = [0.0] * n, [0] * n
    where = {p: i for i, p in enumerate(at)}
    shortest = -(-length // 4) if shortest is None else shortest
    powers = [p for p in (1 << k for k in range(length.bit_length() - 1, -1, -1)) if shortest <= p < length]
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])
    for j in range(1, n):
        here = at[j]
        while at[queue[0][1]] < here - length:
            queue.popleft()
        value, best = queue[0]
        value += length - here  # cost of the start plus padding
        for power in powers:
            i = where.get(here - power)
            if i is not None and cost[i] < value:
                value, best = cost[i], i
        value += price[j] + window
        cost[j], come[j] = value, best
        key = value + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    cuts, j = [], n - 1
    while j:
        cuts.append(at[j])
        j = come[j]
    return cuts[::-1]


def _candidates(ids: np.ndarray, doc_ends: np.ndarray, stops: np.ndarray, length: int):
    """Places where a cut may be, and the penalty of each; the stream's end is the last."""
    sentence = np.flatnonzero(stops[ids]) + 1
    places = np.union1d(sentence, np.append(doc_ends, len(ids)))
    steps = np.diff(places, prepend=0)
    forced = [
        np.arange(places[i] - steps[i] + length, places[i], length) for i in np.flatnonzero(steps > length)
    ]
    if forced:
        places = np.union1d(places, np.concatenate(forced))
    penalty = np.full(len(places), FORCED_CUT)
    penalty[np.isin(places, sentence)] = SENTENCE_CUT
    penalty[np.isin(places, doc_ends)] = 0.0
    penalty[-1] = 0.0
    return places, penalty


def sentence_ends(coder) -> np.ndarray:
    """For each token, whether a sentence may end after it: a closing mark or a line break."""
    texts = (coder.library.decode([i], skip_special_tokens=False) for i in range(coder.size))
    return np.array([t.rstrip().endswith((".", "!", "?", "。", "！", "？")) or "\n" in t for t in texts])


def _powers(start: int, end: int) -> list[int]:
    cuts = []
    while start < end:
        start += 1 << ((end - start).bit_length() - 1)
        cuts.append(start)
    return cuts


class Packer:
    """Takes documents in order and gives the pieces of finished windows."""

    def __init__(self, stops: np.ndarray, length: int, block: int, first_sequence: int):
        self.stops, self.length, self.block, self.sequence = stops, length, block, first_sequence
        self.ids: list[np.ndarray] = []
        self.docs: list[tuple[int | None, int, int]] = []  # id, tokens before the buffer, tokens
        self.size = 0

    def add(self, doc: int | None, ids: np.ndarray) -> Iterator[tuple]:
        self.ids.append(ids)
        self.docs.append((doc, 0, len(ids)))
        self.size += len(ids)
        if self.size >= self.block:
            yield from self._solve(False)

    def finish(self) -> Iterator[tuple]:
        if self.size:
            yield from self._solve(True)

    def _solve(self, end: bool) -> Iterator[tuple]:
        ids = np.concatenate(self.ids)
        doc_ends = np.cumsum([n - skipped for _, skipped, n in self.docs])
        cuts = cut_windows(*_candidates(ids, doc_ends, self.stops, self.length), self.length, shortest=1)
        if end:
            before = cuts[-2] if len(cuts) > 1 else 0
            cuts = cuts[:-1] + _powers(before, cuts[-1])
        elif len(cuts) > 1:
            cuts = cuts[:-1]
        yield from self._pieces(ids, doc_ends, np.array(cuts))
        done = cuts[-1]
        first = int(np.searchsorted(doc_ends, done, "right"))
        rest = self.docs[first:]
        if rest:
            begun = int(doc_ends[first] - (rest[0][2] - rest[0][1]))
            rest[0] = (rest[0][0], rest[0][1] + max(0, done - begun), rest[0][2])
        self.docs, self.ids, self.size = rest, [ids[done:]], len(ids) - done

    def _pieces(self, ids: np.ndarray, doc_ends: np.ndarray, cuts: np.ndarray) -> Iterator[tuple]:
        import zlib

        stop = np.union1d(cuts, doc_ends[doc_ends <= cuts[-1]])
        start = np.concatenate([[0], stop[:-1]])
        doc = np.searchsorted(doc_ends, start, "right")
        window = np.searchsorted(cuts, start, "right")
        doc_starts = np.concatenate([[0], doc_ends[:-1]])
        window_starts = np.concatenate([[0], cuts[:-1]])
        wide = ids.astype("<u4")
        for a, b, d, w in zip(start.tolist(), stop.tolist(), doc.tolist(), window.tolist(), strict=True):
            name, skipped, tokens = self.docs[d]
            yield (
                name,
                a - int(doc_starts[d]) + skipped,
                b - a,
                zlib.crc32(wide[a:b]),
                tokens,
                self.sequence + w,
                a - int(window_starts[w]),
                wide[a:b],
            )
        self.sequence += len(cuts)


def _pack(vocabulary: str, length: int, block: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder = encoder(vocabulary)
        stops = worker_state(f"ends:{vocabulary}", lambda: sentence_ends(coder))
        packer = Packer(stops, length, block, TaskContext.get().partitionId() << 40)
        names = [f.split()[0] for f in PIECES.split(", ")]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(c, pa.int64()) for c in columns[:-1]]
            if with_ids:
                arrays.append(pa.array([x.tolist() for x in columns[-1]], pa.list_(pa.int64())))
            return pa.RecordBatch.from_arrays(arrays, names=[*names, "ids"] if with_ids else names)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                flat, ends = coder.encode(some.column(1).to_pylist())
                rows = []
                for doc, ids in zip(some.column(0).to_pylist(), np.split(flat, ends[:-1]), strict=True):
                    rows.extend(packer.add(doc, ids))
                if rows:
                    yield out(rows)
        if rows := list(packer.finish()):
            yield out(rows)

    return run


def pack(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    length: int = LENGTH,
    block: int = BLOCK,
    with_ids: bool = False,
) -> DataFrame:
    """A row per piece of a document in a sequence; with its token ids if asked.

    Documents are packed where they are read, without a shuffle; sequence ids are unique, and those
    of one partition rise in its order.
    """
    schema = PIECES + (", ids array<bigint>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_pack(vocabulary, length, block, with_ids), schema)
