"""Exact similarity join of documents by the Jaccard distance of their word shingles.

The Jaccard distance is a metric, but documents taken at random are all at distance 1 from each
other, so regions around document pivots alone cannot part them: every document would be replicated to
every region. The shingles are therefore first dealt into classes by hash. Linked sets differ in
few shingles, fewer than there are classes, so in some class they are equal: at distance 0 from one pivot of
that class. A cell (class and the set's part in it) is a region of the first level, and every
linked pair shares one.

Within the cells that share a smallest document, that document is the pivot. Distances to it are
computed exactly; documents within the linking distance of it are linked to it and so to each other.
What lies further out is parted into rings of that width. By the triangle inequality a link spans
neighbouring rings at most, so each ring is joined with itself and the next only, large rings in
blocks. Components of the links found are components of all links.

Most documents are near no other. With ``screen``, such are set aside first; it pays where cells outweigh the
texts, as for low shares. In the order of their hashes, the first
elements that two linked sets have in common lie near the beginning of both: of a set of n, among the first
n - part + k, if k of them are asked for. So a document that may be linked has at least that many elements at its
beginning which other documents have at theirs; passages that documents share are too few. The
beginnings are compared by short hashes in buckets of the hash range. Of the documents that reach the number, all
elements are compared in the same way: a set linked to another has part / whole of its own elements in common with
it, so a document of which the others, taken together, have fewer is linked to none. Documents that share a passage
and nothing else end here; only the rest have cells.

Whether sets are equal and how far they are apart is decided on 64-bit hashes of the shingles.

Defined cases: a null or wordless text has an empty set, linked with nothing; a text of fewer words
than a shingle has its whole sequence as one; equal sets are linked; rows without id have no
component and take no part; rows of one id count as one document with several sets; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelane.llm.common import discard, pieces, tidy, tidy_group, written
from quotelane.llm.graph import components
from quotelane.llm.shingles import chunked, mix, shingle_sets

SHARE = (90, 100)
WIDTH = 3
BAND = 1.5
ENTRIES_PER_BUCKET = 400_000
BLOCK = 512
# A bit map of ids has 16 bits an id, 64 MiB at most; beyond 32 million ids it lets more others through.
MOST_FILTER_BITS = 1 << 29
# One in so many elements is asked for at the beginning of a set.
ASKED_SHARE = 10


class Plan:
    """How sets of each size are dealt into classes, for links of at least part / whole."""

    def __init__(self, part: int, whole: int):
        self.part, self.whole = part, whole
        # the smaller set of a linked pair has a, and then they differ in a * (whole - part) / part at most
        least = -(-part // (whole - part)) if whole > part else 1 << 40
        bounds = [least]
        while bounds[-1] < 1 << 40:
            bounds.append(math.ceil(bounds[-1] * BAND) + 1)
        self.bounds = np.array(bounds, np.int64)
        tops = self.bounds[1:] - 1
        apart = tops * (whole - part) // part
        # classes beyond those needed leave some equal ones even where a few of a set's classes are empty
        mean = self.bounds[:-1] / np.maximum(1, apart)
        self.spare = 2 + np.ceil(1.5 * apart * np.exp(-0.8 * mean)).astype(np.int64)
        self.classes = apart + 1 + self.spare

    def levels(self, n: np.ndarray) -> list[np.ndarray]:
        """Levels at which a set of a size takes part: its own, and the one below if it may be the
        larger set of a pair there. -1: none."""
        own = np.searchsorted(self.bounds, n, "right") - 1
        below = np.where((own >= 1) & (n * self.part <= (self.bounds[np.maximum(own, 0)] - 1) * self.whole), own - 1, -1)
        return [own, below]


def signatures(codes: np.ndarray, ends: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """Cells of many sets: a 64-bit name per cell and the number of its set.

    An empty class names no cell, unless a set has more empty classes than there are spare ones.
    """
    n = np.diff(ends, prepend=0)
    names, owners = [], []
    scrambled = mix(codes ^ np.uint64(0xA0761D6478BD642F))
    for level in plan.levels(n):
        use = np.flatnonzero(level >= 0)
        if not len(use):
            continue
        lv = level[use]
        r = plan.classes[lv]
        base = np.cumsum(r) - r
        picked = np.repeat(level >= 0, n)
        of = np.repeat(np.arange(len(use)), n[use])
        cls = ((scrambled[picked] >> np.uint64(33)) % r[of].astype(np.uint64)).astype(np.int64)
        slot = base[of] + cls
        total = int(r.sum())
        order = np.argsort(slot, kind="stable")
        slot, value = slot[order], mix(codes[picked][order] + np.uint64(0x5851F42D4C957F2D))
        sums = np.zeros(total, np.uint64)
        filled = np.zeros(total, bool)
        if len(slot):
            first = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
            sums[slot[first]] = np.add.reduceat(value, first)
            filled[slot[first]] = True
        owner = np.repeat(np.arange(len(use)), r)
        number = np.arange(total) - np.repeat(base, r)
        empty = r - np.bincount(owner[filled], minlength=len(use))
        keep = filled | (empty > plan.spare[lv])[owner]
        tag = mix((lv[owner].astype(np.uint64) << np.uint64(40)) + number.astype(np.uint64))
        names.append(mix(sums + tag)[keep])
        owners.append(use[owner][keep])
    if not names:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(names), np.concatenate(owners)


def _ints(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values, pa.int64())


def _blobs(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    raw = values.tobytes()
    return pa.array([raw[8 * a : 8 * b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)], pa.binary())


def _described(width: int, plan: Plan | None):
    """doc_id, set size, set hash (two parts), and the cells if asked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in chunked(texts):
                codes, ends = shingle_sets(texts[a:b], width)
                n = np.diff(ends, prepend=0)
                keys = np.zeros((2, b - a), np.uint64)
                some = np.flatnonzero(n)
                if len(some):
                    starts = (ends - n)[some]
                    keys[0, some] = np.add.reduceat(mix(codes), starts)
                    keys[1, some] = np.add.reduceat(mix(codes ^ np.uint64(0x8EBC6AF09C88C6E3)), starts)
                columns = [batch.column(0).slice(a, b - a), pa.array(n, pa.int64()), _ints(keys[0]), _ints(keys[1])]
                names = ["doc_id", "n", "k1", "k2"]
                if plan:
                    cells, owner = signatures(codes, ends, plan)
                    order = np.argsort(owner, kind="stable")
                    count = np.bincount(owner, minlength=b - a)
                    columns.append(_blobs(cells[order], np.cumsum(count)))
                    names.append("cells")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _narrow(values: np.ndarray) -> tuple[int, bytes]:
    """Numbers as a base and 32-bit steps where they fit, else 64-bit ones (base -1)."""
    low = int(values.min())
    if low >= 0 and int(values.max()) - low < 1 << 32:
        return low, (values - low).astype("<u4").tobytes()
    return -1, values.astype("<i8").tobytes()


def _widen(base: int, raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<i8") if base < 0 else np.frombuffer(raw, "<u4").astype(np.int64) + base


def _beginning(n, part: int, whole: int):
    """How many of a set's elements are its beginning."""
    return np.minimum(n, n - -(-part * n // whole) + 1 + n // ASKED_SHARE)


def _least(n: Column, part: int, whole: int) -> Column:
    """The smallest set that one of n elements may be linked to, and how many elements it shares with any."""
    return (-F.floor(-n * part / whole)).cast("long")


def _needed(n: Column, part: int, whole: int) -> Column:
    """How many of its beginning a linked document shares: the smaller of two linked sets has part / whole
    of the larger at least, and each set asks for its own number."""
    return (1 + F.floor(_least(n, part, whole) / ASKED_SHARE)).cast("long")


OFFERED = pa.schema([("bucket", pa.int32()), ("names", pa.binary()), ("refs", pa.binary()), ("known", pa.binary())])


def _short(refs: np.ndarray) -> bytes:
    """48-bit numbers in six bytes each."""
    return refs.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _long(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def _sorted_names(codes: np.ndarray, bits: int) -> np.ndarray:
    return mix(codes ^ np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - bits)


def _steps(names: np.ndarray) -> bytes:
    """Sorted numbers as the first and 32-bit steps where they fit, else as they are (marked by their first byte)."""
    steps = np.diff(names)
    if not len(steps) or int(steps.max()) < 1 << 32:
        return b"\x00" + names[:1].tobytes() + steps.astype("<u4").tobytes()
    return b"\x01" + names.tobytes()


def _from_steps(raw: bytes) -> np.ndarray:
    if raw[0]:
        return np.frombuffer(raw, "<u8", offset=1)
    first = np.frombuffer(raw, "<u8", 1, 1)
    return np.cumsum(np.append(first, np.frombuffer(raw, "<u4", offset=9).astype(np.uint64)))


def _offer(width: int, taken: Callable[[np.ndarray], np.ndarray], buckets: int, bits: int):
    """The first elements of sets, as many as ``taken`` tells by their sizes, packed by bucket. What a chunk of documents
    holds twice is known to be shared: it is counted here (buckets below 0) and sent once, marked, so no bucket gathers a
    frequent element."""

    def packed(codes: np.ndarray, ends: np.ndarray) -> pa.RecordBatch | None:
        n = np.diff(ends, prepend=0)
        some = np.flatnonzero(n)
        if not len(some):
            return None
        starts = (ends - n)[some]
        refs = np.add.reduceat(mix(codes), starts) >> np.uint64(16)
        first = taken(n[some])
        at = np.repeat(starts - (np.cumsum(first) - first), first) + np.arange(first.sum())
        names, owner = _sorted_names(codes[at], bits), np.repeat(refs, first)
        order = np.lexsort((owner, names))
        names, owner = names[order], owner[order]
        new = np.append(True, (names[1:] != names[:-1]) | (owner[1:] != owner[:-1]))  # equal sets are one
        names, owner = names[new], owner[new]
        again = np.append(False, names[1:] == names[:-1])
        shared = again.copy()
        shared[:-1] |= again[1:]
        rows: tuple[list, ...] = ([], [], [], [])

        def put(bucket: np.ndarray, make) -> None:
            if not len(bucket):
                return
            cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            for a, b in zip(cuts, np.append(cuts[1:], len(bucket)), strict=True):
                for column, value in zip(rows, (int(bucket[a]), *make(a, b)), strict=True):
                    column.append(value)

        sent_names, sent_refs, sent_known = names[~again], owner[~again], shared[~again]
        # buckets are ranges of the names, so steps within them are short
        places = (sent_names >> np.uint64(bits - 24)) * np.uint64(buckets) >> np.uint64(24)
        put(places.astype(np.int64), lambda a, b: (_steps(sent_names[a:b]), _short(sent_refs[a:b]), np.packbits(sent_known[a:b]).tobytes()))
        mine, counts = np.unique(owner[shared], return_counts=True)
        home = -1 - (mix(mine) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(home, kind="stable")
        mine, counts, home = mine[order], counts[order], home[order]
        put(home, lambda a, b: (counts[a:b].astype("<u4").tobytes(), _short(mine[a:b]), b""))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, OFFERED, strict=True)], schema=OFFERED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in chunked(texts):
                out = packed(*shingle_sets(texts[a:b], width))
                if out is not None:
                    yield out

    return run


def _counted(table: pa.Table) -> pa.Table:
    """The shared elements of one bucket: a row for each document that has one (or its count of a chunk)."""
    bucket = table.column("bucket")[0].as_py()
    refs = np.concatenate([_long(r) for r in table.column("refs").to_pylist()])
    if bucket < 0:
        counts = np.concatenate([np.frombuffer(c, "<u4") for c in table.column("names").to_pylist()])
    else:
        names = np.concatenate([_from_steps(r) for r in table.column("names").to_pylist()])
        sizes = [len(r) // 6 for r in table.column("refs").to_pylist()]
        known = [np.unpackbits(np.frombuffer(k, np.uint8), count=c) for k, c in zip(table.column("known").to_pylist(), sizes, strict=True)]
        known = np.concatenate(known).astype(bool)
        order = np.lexsort((refs, names))
        names, refs, known = names[order], refs[order], known[order]
        first = np.append(True, names[1:] != names[:-1])
        group = np.cumsum(first) - 1
        apart = np.append(True, first[1:] | (refs[1:] != refs[:-1]))
        several = (np.bincount(group, weights=apart) > 1) | (np.bincount(group, weights=known) > 0)
        # marked ones are counted where they come from
        refs = refs[several[group] & ~known & apart]
        counts = np.ones(len(refs), np.int64)
    return pa.table({"ref": pa.array(refs.astype(np.int64)), "shared": pa.array(counts.astype(np.int64))})


def _bit_map(ids: DataFrame, count: int) -> tuple[np.ndarray, int]:
    """A bit map of ids and its number of bits, which is bounded."""
    size = 1 << 16
    while size < 16 * count and size < MOST_FILTER_BITS:
        size *= 2

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = mix(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)) & np.uint64(size - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array((at >> np.uint64(6)).astype(np.int64)), _ints(np.uint64(1) << (at & np.uint64(63)))], names=["place", "bit"]
            )

    marks = ids.mapInArrow(places, "place long, bit long").groupBy("place").agg(F.bit_or("bit").alias("bits")).toPandas()
    bits = np.zeros(size // 64, np.uint64)
    bits[marks["place"].to_numpy()] = marks["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return bits, size


def _maybe(held):
    """Rows whose id (first column) may be in the bit map."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, size = held.value
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            at = mix(ids.astype(np.int64).view(np.uint64)) & np.uint64(size - 1)
            maybe = (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)
            yield batch.take(pa.array(np.flatnonzero(maybe)))

    return run


ASKED = pa.schema([("bucket", pa.int32()), ("shared", pa.bool_()), ("cells", pa.binary()), ("base", pa.int64()), ("reps", pa.binary())])


def _ask(buckets: int):
    """Entries (cell, rep) packed by bucket. Entries of a cell that a batch holds twice are known to be
    shared; all but one of them are dealt evenly, so no bucket gathers a frequent cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = batch.column(1).to_pylist()
            cells = np.frombuffer(b"".join(blobs), np.uint64)
            if not len(cells):
                continue
            reps = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), [len(b) // 8 for b in blobs])
            order = np.lexsort((reps, cells))
            cells, reps = cells[order], reps[order]
            new = np.append(True, (cells[1:] != cells[:-1]) | (reps[1:] != reps[:-1]))  # equal sets are one
            cells, reps = cells[new], reps[new]
            again = np.zeros(len(cells), bool)
            again[1:] = cells[1:] == cells[:-1]
            known = again.copy()
            known[:-1] |= again[1:]
            rows: tuple[list, ...] = ([], [], [], [], [])
            for shared, use in ((False, ~again), (True, known)):
                c, r = cells[use], reps[use]
                home = c if not shared else mix(c + r.astype(np.uint64))
                bucket = (mix(home) % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                c, r, bucket = c[order], r[order], bucket[order]
                cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else []
                for a, b in zip(cuts, [*cuts[1:], len(bucket)], strict=True) if len(bucket) else []:
                    base, raw = _narrow(r[a:b])
                    for column, value in zip(rows, (int(bucket[a]), shared, c[a:b].tobytes(), base, raw), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, ASKED, strict=True)], schema=ASKED)

    return run


def _shared(table: pa.Table) -> pa.Table:
    """Entries of a bucket whose cell has two documents at least."""
    parts: dict[bool, tuple[list, list]] = {False: ([], []), True: ([], [])}
    for _, shared, cells, base, reps in zip(*(c.to_pylist() for c in table.columns), strict=True):
        parts[shared][0].append(np.frombuffer(cells, np.uint64))
        parts[shared][1].append(_widen(base, reps))
    found = [(np.concatenate(c), np.concatenate(r)) for c, r in parts.values() if c]
    if parts[False][0]:
        cells, reps = found[0]
        order = np.lexsort((reps, cells))
        cells, reps = cells[order], reps[order]
        new = np.append(True, (cells[1:] != cells[:-1]) | (reps[1:] != reps[:-1]))
        cells, reps = cells[new], reps[new]
        same = cells[1:] == cells[:-1]
        use = np.append(same, False) | np.append(False, same)
        found[0] = (cells[use], reps[use])
    return pa.table({"cell": _ints(np.concatenate([c for c, _ in found])), "rep": pa.array(np.concatenate([r for _, r in found]), pa.int64())})


def _sets_of(width: int):
    """The sets of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in chunked(texts):
                codes, ends = shingle_sets(texts[a:b], width)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), _blobs(codes, ends)], names=["rep", "set"])

    return run


def _measure(part: int, whole: int):
    """Distances of documents to their pivots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far, linked = [], []
            for one, two in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                union = len(x) + len(y) - common
                linked.append(whole * common >= part * union)
                far.append(1 - common / union)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(far, pa.float64()), pa.array(linked, pa.bool_())],
                names=["pivot", "rep", "far", "linked"],
            )

    return run


def _overlaps(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of x with every set of y."""
    values = np.concatenate([*x, *y]) if x or y else np.empty(0, np.uint64)
    _, column, count = np.unique(values, return_inverse=True, return_counts=True)
    often = count > 1
    name = np.cumsum(often) - 1
    row = np.repeat(np.arange(len(x) + len(y)), [len(s) for s in (*x, *y)])
    use = often[column]
    row, column = row[use], name[column[use]]
    out = np.zeros((len(x), len(y)), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    step = 4096
    for low in range(0, int(often.sum()), step):
        a, b = np.searchsorted(column, [low, low + step])
        dense = np.zeros((len(x) + len(y), step), np.float32)
        dense[row[a:b], column[a:b] - low] = 1
        out += dense[: len(x)] @ dense[len(x) :].T
    return out.astype(np.int64)


def _join_blocks(part: int, whole: int):
    """Links between two blocks of a region, as each document's smallest linked one, until stable."""

    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        ids = table.column("rep").to_numpy()
        sets = [np.frombuffer(s, np.uint64) for s in table.column("set").to_pylist()]
        left, right = np.flatnonzero(side != 2), np.flatnonzero(side != 1)
        empty = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        if not len(left) or not len(right) or len(ids) < 2:
            return empty
        sizes = np.array([len(s) for s in sets])
        common = _overlaps([sets[i] for i in left], [sets[i] for i in right])
        linked = whole * common >= part * (sizes[left][:, None] + sizes[right][None, :] - common)
        label = ids.copy()
        top = np.iinfo(np.int64).max
        while True:
            low = np.minimum(label[left], np.where(linked, label[right][None, :], top).min(1))
            high = np.minimum(label[right], np.where(linked, label[left][:, None], top).min(0))
            after = label.copy()
            np.minimum.at(after, left, low)
            np.minimum.at(after, right, high)
            if (after == label).all():
                break
            label = after
        use = label != ids
        return pa.table({"a": pa.array(ids[use], pa.int64()), "b": pa.array(label[use], pa.int64())})

    return run


def _ringed(star: DataFrame, part: int, whole: int) -> DataFrame:
    """Rings of the documents of those pivots of which one document at least isn't linked to them."""
    wide = (whole - part) / whole * (1 + 1e-12)
    ring = F.when(F.col("linked"), 0).otherwise(F.greatest(F.lit(1), F.floor(F.col("far") / wide))).cast("int")
    open_pivots = star.where(~F.col("linked")).select("pivot").distinct()
    # written, as its counts are asked for several times
    return written(star.join(open_pivots, "pivot", "left_semi").select("pivot", "rep", ring.alias("ring")), "rings", light=True)


def _regions(ringed: DataFrame, sets: DataFrame, part: int, whole: int) -> DataFrame:
    """Links among documents of one pivot of which one at least isn't linked to it."""
    counts = ringed.groupBy("pivot", "ring").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    beside = counts.select("pivot", (F.col("ring") + 1).alias("ring"), F.col("blocks").alias("below")).join(
        counts.select("pivot", (F.col("ring") - 1).alias("ring"), F.col("blocks").alias("above")), ["pivot", "ring"], "full"
    )
    placed = (
        ringed.join(counts.join(beside, ["pivot", "ring"], "left"), ["pivot", "ring"])
        .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .withColumn("below", F.coalesce("below", F.lit(0)))
        .withColumn("above", F.coalesce("above", F.lit(0)))
    )

    def pairs(count: F.Column, make) -> F.Column:
        return F.when(count > 0, F.transform(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1), make)).otherwise(
            F.array().cast("array<struct<r1:int,b1:int,r2:int,b2:int,side:int>>")
        )

    def pair(r1, b1, r2, b2, side) -> F.Column:
        named = zip((r1, b1, r2, b2, side), ("r1", "b1", "r2", "b2", "side"), strict=True)
        return F.struct(*[c.cast("int").alias(n) for c, n in named])

    r, b = F.col("ring"), F.col("block")
    same = F.when(
        r > 0,
        pairs(
            F.col("blocks"),
            lambda o: pair(r, F.least(b, o), r, F.greatest(b, o), F.when(o == b, 0).when(b < o, 1).otherwise(2)),
        ),
    ).otherwise(F.array().cast("array<struct<r1:int,b1:int,r2:int,b2:int,side:int>>"))
    under = pairs(F.col("below"), lambda o: pair(r - 1, o, r, b, F.lit(2)))
    over = pairs(F.col("above"), lambda o: pair(r, b, r + 1, o, F.lit(1)))
    dealt = placed.select("pivot", "rep", F.explode(F.concat(same, under, over)).alias("to")).select("pivot", "rep", "to.*")
    full = dealt.join(sets, "rep")
    return full.groupBy("pivot", "r1", "b1", "r2", "b2").applyInArrow(tidy_group(_join_blocks(part, whole)), "a long, b long")


def _sharing(
    texts: DataFrame, reps: DataFrame, width: int, offered: int | None, taken: Callable, needed: Column, label: str
) -> DataFrame:
    """Of the sets in ``reps``, those that share ``needed`` at least of the elements ``taken`` with any others of
    ``texts``; ``offered``: how many elements are taken in all."""
    buckets = pieces(offered, ENTRIES_PER_BUCKET * 2)
    bits = min(64, max(24, int(offered or 1).bit_length() + 16))
    counted = (
        texts.mapInArrow(tidy(_offer(width, taken, buckets, bits)), "bucket int, names binary, refs binary, known binary")
        .groupBy("bucket")
        .applyInArrow(tidy_group(_counted), "ref long, shared long")
        .groupBy("ref")
        .agg(F.sum("shared").alias("shared"))
    )
    counted = written(counted, f"{label}-counts", light=True, release=True)
    met = reps.withColumn("ref", F.shiftrightunsigned("k1", 16)).join(counted, "ref")
    found = written(met.where(F.col("shared") >= needed).drop("ref", "shared"), label, light=True)
    discard(counted)
    return found


def _texts_of(texts: DataFrame, reps: DataFrame) -> DataFrame:
    """The texts of the sets in ``reps``, and a few others."""
    held = texts.sparkSession.sparkContext.broadcast(_bit_map(reps.select("rep").distinct(), reps.count()))
    return texts.mapInArrow(_maybe(held), "doc_id long, text string")


def _screened(texts: DataFrame, light: DataFrame, reps: DataFrame, width: int, share: tuple[int, int]) -> DataFrame:
    """Of the sets in ``reps``, those that have enough in common with others to be linked at all."""
    part, whole = share
    n = F.col("n")
    offered = light.agg(F.sum(n + 1 + F.floor(n / ASKED_SHARE) + F.floor(-n * part / whole))).first()[0]
    met = _sharing(texts, reps, width, offered, lambda n: _beginning(n, part, whole), _needed(n, part, whole), "beginnings")
    offered = met.agg(F.sum(n)).first()[0]
    near = _sharing(_texts_of(texts, met), met, width, offered, lambda n: n, _least(n, part, whole), "near")
    discard(met)
    return near


def classes(docs: DataFrame, width: int = WIDTH, share: tuple[int, int] = SHARE, screen: bool = False) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) of every row."""
    part, whole = share
    plan = Plan(part, whole)
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    fields = "doc_id long, n long, k1 long, k2 long"
    light = written(texts.mapInArrow(tidy(_described(width, None)), fields), "sets")
    named_texts = texts.where("doc_id IS NOT NULL")
    keyed = light.where("doc_id IS NOT NULL").select("doc_id", "n", "k1", "k2")
    # equal sets are one: the text of smallest id stands for them
    reps = written(keyed.where("n > 0").groupBy("k1", "k2", "n").agg(F.min("doc_id").alias("rep")), "reps", light=True)
    if screen:
        near = _screened(named_texts, light, reps, width, share)
        some = _texts_of(named_texts, near)
    else:
        near, some = reps, named_texts
    # until pairs are found a set goes by its hash, then by its smallest id
    heavy = (
        some.mapInArrow(tidy(_described(width, plan)), fields + ", cells binary")
        .where("length(cells) > 0")
        .select(F.col("k1").alias("rep"), "cells")
    )
    entries = near.agg(F.sum("n")).first()[0]
    buckets = pieces(entries, ENTRIES_PER_BUCKET * 2)
    asked = heavy.mapInArrow(tidy(_ask(buckets)), "bucket int, shared boolean, cells binary, base long, reps binary")
    entries = written(asked.groupBy("bucket").applyInArrow(tidy_group(_shared), "cell long, rep long"), "cells", release=True)
    pivots = entries.groupBy("cell").agg(F.min("rep").alias("pivot"))
    hashed = entries.join(pivots, "cell").where("rep <> pivot").select("pivot", "rep").distinct()
    names = near.groupBy("k1").agg(F.min("rep").alias("name"))
    pairs = written(
        hashed.join(names.select(F.col("k1").alias("pivot"), F.col("name").alias("p")), "pivot")
        .join(names.select(F.col("k1").alias("rep"), F.col("name").alias("r")), "rep")
        .select(F.col("p").alias("pivot"), F.col("r").alias("rep")),
        "pairs",
        light=True,
        release=True,
    )
    discard(entries)
    # a bit map says which documents' sets may be wanted; the joins decide
    wanted = written(pairs.select("rep").unionByName(pairs.select(F.col("pivot").alias("rep"))).distinct(), "asked", light=True)
    chosen = spark.sparkContext.broadcast(_bit_map(wanted, wanted.count()))
    sets = named_texts.mapInArrow(_maybe(chosen), "doc_id long, text string").mapInArrow(tidy(_sets_of(width)), "rep long, set binary")
    sets = written(sets.join(wanted, "rep", "left_semi").dropDuplicates(["rep", "set"]), "wanted", release=True)
    star = written(
        pairs.join(sets, "rep")
        .select("pivot", "rep", "set")
        .join(sets.select(F.col("rep").alias("pivot"), F.col("set").alias("pivot_set")), "pivot")
        .select("pivot", "rep", "set", "pivot_set")
        .mapInArrow(tidy(_measure(part, whole)), "pivot long, rep long, far double, linked boolean"),
        "star",
        release=True,
    )
    links = star.where("linked").select(F.col("rep").alias("a"), F.col("pivot").alias("b"))
    ringed = _ringed(star, part, whole)
    links = links.unionByName(_regions(ringed, sets, part, whole))
    found = components(links)
    discard(ringed, star, sets, wanted, pairs, *([near] if screen else []))
    named = reps.join(found, reps["rep"] == found["node"], "left").select(
        "k1", "k2", "n", F.coalesce("component", "rep").alias("component_id")
    )
    full = light.join(named, ["k1", "k2", "n"], "left")
    own = F.when(F.col("n") == 0, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return full.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
