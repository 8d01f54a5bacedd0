"""Remove byte strings that documents with smaller ids have too, found by sorting suffixes.

Texts are sampled by minimisers: in every string of ``LENGTH`` bytes, the k-gram of least hash is an
anchor, the same one wherever the string stands. Equal strings therefore share an anchor, and the
neighbourhoods of equal anchors (all strings that have it) can be compared apart from all others.

1. Equal texts are one; all but the one of smallest id are removed whole.
2. Documents are dealt into groups, each a few megabytes. The groups ask, by hash of the anchor, which anchors
   other groups have too.
3. The neighbourhoods of shared anchors go to buckets by hash of the anchor. A bucket sorts all their suffixes in
   two stages: suffixes smaller than their successors are sorted directly, the rest follow by
   scanning the buckets of first bytes in order. Adjacent common prefixes of at least ``LENGTH`` bytes
   make runs of equal strings; a string is removed where a smaller id is in its run. Groups count the neighbourhoods
   of every anchor when they ask; an anchor with more than a part of a bucket's is hot, and its strings go to buckets
   of their own, each by hash of its own bytes, once a group with the least id. Both kinds of bucket are as many as
   what they take needs.
4. The answers return to the groups, which cut the removed bytes out.

A group sends an anchor, and each distinct neighbourhood or string, once, however many of its documents have it.

Defined cases: a null text is empty; texts shorter than the length keep all bytes; rows of one id
don't remove from each other; rows without id remove nothing and lose nothing; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelane.llm.common import pieces, written
from quotelane.llm.shingles import mix

LENGTH = 50
# Spark takes 100,000 buckets of a table at most.
MOST_TABLE_BUCKETS = 16_384
GRAM = 16
GROUP_BYTES = 6 << 20
BUCKET_BYTES = 4 << 20
FEW = 16  # neighbourhoods of an anchor in a group that are counted without a look at their bytes
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


# ---- suffix sorting ------------------------------------------------------------------------------


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from every place as one number, the first byte highest; zeros past the end."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    out = np.zeros(len(text), np.uint64)
    for k in range(8):
        out |= padded[k : k + len(text)].astype(np.uint64) << np.uint64(8 * (7 - k))
    return out


def _sort_directly(at: np.ndarray, words: np.ndarray, left: np.ndarray, deep: int) -> np.ndarray:
    """Suffixes at some places in order of ``deep`` bytes: by eight, then the ties by the next eight, and so on."""
    key = words[at]
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    same = key[1:] == key[:-1]
    tied = np.flatnonzero(np.append(same, False) | np.append(False, same))
    group = np.cumsum(np.append(True, ~same))[tied] if len(at) else tied
    depth = 8
    while len(tied) and depth < deep:
        some = at[tied]
        more = left[some] > depth
        if not more.any():
            break
        deeper = np.where(more, words[np.minimum(some + depth, len(words) - 1)], 0)
        order = np.lexsort((deeper, group))
        at[tied], deeper = some[order], deeper[order]
        same = (deeper[1:] == deeper[:-1]) & (group[1:] == group[:-1])
        again = np.append(same, False) | np.append(False, same)
        group = np.cumsum(np.append(True, ~same))
        tied, group, depth = tied[again], group[again], depth + 8
    return at


def _left(text: np.ndarray) -> np.ndarray:
    """Bytes from every place to its string's zero."""
    end = np.flatnonzero(text == 0)
    return np.repeat(end, np.diff(end, prepend=-1)) - np.arange(len(text))


def suffix_array(text: np.ndarray, deep: int = 1 << 30) -> np.ndarray:
    """Order of the suffixes of strings of bytes above zero, joined with a zero after each.

    A suffix ends at its string's zero; equal suffixes stand together, in any order, and so do
    suffixes with ``deep`` equal bytes.

    Only suffixes smaller than their successor are sorted by their bytes. Every other suffix is
    greater than its successor, so scanning the buckets of first bytes in order meets the successor
    before the place of the suffix: suffixes are set down in the order in which their successors are met.
    """
    n = len(text)
    end = np.flatnonzero(text == 0)
    change = np.flatnonzero(np.append(text[:-1] != text[1:], True))
    run = np.repeat(change, np.diff(change, prepend=-1))
    small = (text[run] < text[np.minimum(run + 1, n - 1)]) & (text > 0)
    left = _left(text)
    past = np.minimum(np.maximum(0, 8 - left), 7).astype(np.uint64) * np.uint64(8)
    words = (_words(text) >> past) << past
    words[end] = 0
    direct = _sort_directly(np.flatnonzero(small), words, left, deep)
    bounds = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = [end]

    def induce(met: np.ndarray, byte: int) -> np.ndarray:
        """Set down the greater predecessors of suffixes; returns those of the same bucket."""
        before = met[met > 0] - 1
        before = before[~small[before] & (text[before] > 0)]
        value = text[before]
        same, later = before[value == byte], value > byte
        before, value = before[later], value[later]
        order = np.argsort(value, kind="stable")
        before, value = before[order], value[order]
        if len(value):
            cuts = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
            for a, b in zip(cuts, [*cuts[1:], len(value)], strict=True):
                waiting[int(value[a])].append(before[a:b])
        return same

    induce(end, 0)
    for byte in range(1, 256):
        met = np.concatenate(waiting[byte]) if waiting[byte] else end[:0]
        waiting[byte] = []
        while len(met):
            out.append(met)
            met = induce(met, byte)
        met = direct[bounds[byte] : bounds[byte + 1]]
        if len(met):
            out.append(met)
            induce(met, byte)
    return np.concatenate(out)


def equal_runs(text: np.ndarray, order: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes, in order, of at least ``length`` bytes, and the number of the run of each: adjacent
    ones are in one run if their common prefix has that length."""
    order = order[_left(text)[order] >= length]
    same = np.ones(max(0, len(order) - 1), bool)
    words = _words(text)
    for depth in [*range(0, length - 7, 8), length - 8]:
        value = words[order + depth]
        same &= value[1:] == value[:-1]
    return order, np.cumsum(np.append(True, ~same))[: len(order)] - 1


# ---- anchors -------------------------------------------------------------------------------------


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """Least or greatest of every ``width`` neighbours, by doubling."""
    size = 1
    while size < width:
        step = min(size, width - size)
        values = pick(values[: len(values) - step], values[step:])
        size += step
    return values


CHUNK = 1 << 18


def anchors(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors of texts that follow each other, rising, and a hash of each: grams of least
    32-bit hash among all grams of some string of ``length`` bytes within a text (all, if several are)."""
    reach = length - gram + 1
    found = []
    first = start = 0
    while first < len(ends):
        last = max(first + 1, int(np.searchsorted(ends, start + CHUNK, "right")))
        stop = int(ends[last - 1])
        part = data[start:stop]
        if len(part) >= length:
            code, size = part.astype(np.uint32) + np.uint32(1), 1
            while size < gram:
                step = min(size, gram - size)
                code = code[: len(code) - step] * np.uint32(0x9E3779B1) + code[step:] * np.uint32(0x85EBCA77)
                code ^= code >> np.uint32(15)
                size += step
            code *= np.uint32(0xC2B2AE3D)
            code ^= code >> np.uint32(13)
            np.maximum(code, 1, out=code)
            least = _slide(code, reach, np.minimum)
            for end in ends[first : last - 1].tolist():  # strings that would cross texts
                least[max(0, end - start - length + 1) : end - start] = 0
            # a gram is the least of some string if the greatest least of the strings with it is its own
            edge = np.zeros(reach - 1, np.uint32)
            most = _slide(np.concatenate([edge, least, edge]), reach, np.maximum)
            found.append(np.flatnonzero(most == code) + start)
        first, start = last, stop
    at = np.concatenate(found) if found else np.empty(0, np.int64)
    if not len(at):
        return at, np.empty(0, np.uint64)
    grams = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, gram)[at])
    code = np.zeros(len(at), np.uint64)
    for k in range(0, gram, 8):
        code = mix(code * _A + np.ascontiguousarray(grams[:, k : k + 8]).view(np.uint64).ravel() + np.uint64(k))
    return at, code


# ---- groups of documents -------------------------------------------------------------------------

LEFT, RIGHT = LENGTH - GRAM, LENGTH  # of an anchor's place: what its neighbourhood has on either side
SPAN = LEFT + RIGHT
RECORD = np.dtype([("before", "u1"), ("size", "u1"), ("bytes", "S1", (SPAN,))])


class Group:
    """The documents of a group in a fixed order, with their anchors."""

    def __init__(self, docs: pa.Table, told: pa.Table):
        reps = set(told.filter(told.column("kind").to_numpy() == 0).column("at").to_pylist()) if told.num_rows else set()
        rows = [
            (d, t) for d, t in zip(docs.column("doc_id").to_pylist(), docs.column("text").to_pylist(), strict=True) if d in reps
        ]
        rows = sorted(set(rows))
        self.ids = np.array([d for d, _ in rows], np.int64)
        self.texts = [t for _, t in rows]
        self.told = told
        self.data = np.frombuffer(b"".join(self.texts), np.uint8)
        self.ends = np.cumsum([len(t) for t in self.texts], dtype=np.int64)
        self.at, self.code = anchors(self.data, self.ends, LENGTH, GRAM)  # places in the joined texts
        self.doc = np.searchsorted(self.ends, self.at, "right")
        self.keys, self.key = np.unique(self.code, return_inverse=True)

    def asked(self, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
        """Distinct anchors by bucket."""
        yield from _by_bucket(self.keys, buckets)

    def _span(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the neighbourhoods of some anchors begin and end."""
        begin = np.concatenate([[0], self.ends])
        return np.maximum(begin[self.doc[some]], self.at[some] - LEFT), np.minimum(begin[self.doc[some] + 1], self.at[some] + RIGHT)

    def _held(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """The bytes of neighbourhoods, zeros past their ends."""
        padded = np.concatenate([self.data, np.zeros(SPAN, np.uint8)])
        held = np.lib.stride_tricks.sliding_window_view(padded, SPAN)[start].copy()
        held[np.arange(SPAN)[None, :] >= (stop - start)[:, None]] = 0
        return held

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """For each distinct anchor, its neighbourhoods and the places of their strings. Of more than ``FEW``
        neighbourhoods the distinct ones count, told by a hash."""
        order = np.argsort(self.key, kind="stable")  # places rise within an anchor
        key = self.key[order]
        records = np.bincount(key, minlength=len(self.keys))
        start, stop = self._span(order)
        last = stop - LENGTH
        from_ = start.copy()
        same = key[1:] == key[:-1]
        from_[1:][same] = np.maximum(start[1:], last[:-1] + 1)[same]
        strings = np.bincount(key, weights=np.maximum(0, last - from_ + 1), minlength=len(self.keys))
        much = records[key] > FEW
        if much.any():
            start, stop, key = start[much], stop[much], key[much]
            code = _code(self._held(start, stop)) + mix(key.astype(np.uint64)) + (stop - start).astype(np.uint64)
            _, first = np.unique(code, return_index=True)
            distinct = np.bincount(key[first], minlength=len(self.keys))
            records = np.where(records > FEW, np.maximum(distinct, 1), records)
        return records.astype(np.uint32), strings.astype(np.uint32)

    def _answers(self, kind: int) -> dict[int, bytes]:
        told = self.told.filter(self.told.column("kind").to_numpy() == kind)
        return dict(zip(told.column("at").to_pylist(), told.column("blob").to_pylist(), strict=True))

    def neighbourhoods(self, buckets: int) -> None:
        """Find the shared anchors' neighbourhoods, or strings if hot: distinct ones, the least id of each, whose they are."""
        many, hot = np.zeros(len(self.keys), bool), np.zeros(len(self.keys), bool)
        if len(self.keys):
            # an anchor that two documents of the group have
            order = np.lexsort((self.ids[self.doc], self.key))
            key, ids = self.key[order], self.ids[self.doc][order]
            other = (key[1:] == key[:-1]) & (ids[1:] != ids[:-1])
            many[key[1:][other]] = True
        answers = self._answers(1)
        for bucket, rows in self.asked(buckets):
            if bucket in answers:
                bits = np.frombuffer(answers[bucket], np.uint8).reshape(2, -1)
                bits = np.unpackbits(bits, axis=1, count=len(rows), bitorder="little").astype(bool)
                many[rows] |= bits[0]
                hot[rows] = bits[1]
        self._strings(np.flatnonzero((many & hot)[self.key]) if len(self.keys) else np.empty(0, np.int64))
        use = np.flatnonzero((many & ~hot)[self.key]) if len(self.keys) else np.empty(0, np.int64)
        self.hit_doc, at = self.doc[use], self.at[use]
        records = np.zeros(len(use), RECORD)
        start, stop = self._span(use)
        records["before"], records["size"] = at - start, stop - start
        if len(use):
            records["bytes"] = self._held(start, stop).view("S1")
        self.hit_start, self.hit_code = start, self.code[use]
        raw = np.concatenate([self.hit_code.view(np.uint8).reshape(-1, 8), records.view(np.uint8).reshape(-1, RECORD.itemsize)], 1) if len(use) else np.empty((0, 8 + RECORD.itemsize), np.uint8)
        rows = np.ascontiguousarray(raw).view([("raw", f"V{8 + RECORD.itemsize}")]).ravel()
        distinct, self.hit = np.unique(rows["raw"], return_inverse=True) if len(use) else (rows["raw"], np.empty(0, np.int64))
        flat = distinct.view(np.uint8).reshape(-1, 8 + RECORD.itemsize) if len(distinct) else np.empty((0, 8 + RECORD.itemsize), np.uint8)
        self.codes = np.ascontiguousarray(flat[:, :8]).view(np.uint64).ravel()
        self.records = np.ascontiguousarray(flat[:, 8:])
        self.least = np.full(len(distinct), np.iinfo(np.int64).max)
        np.minimum.at(self.least, self.hit, self.ids[self.hit_doc])

    def _strings(self, use: np.ndarray) -> None:
        """The strings with some anchors: places, distinct strings, the least id of each."""
        start, stop = self._span(use)
        edges = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(edges, start, 1)
        np.add.at(edges, stop - LENGTH + 1, -1)
        self.place = np.flatnonzero(np.cumsum(edges) > 0)
        self.place_doc = np.searchsorted(self.ends, self.place, "right")
        if len(self.place):
            held = np.lib.stride_tricks.sliding_window_view(self.data, LENGTH)[self.place]
            distinct, self.string = np.unique(np.ascontiguousarray(held).view(f"V{LENGTH}").ravel(), return_inverse=True)
            self.strings = distinct.view(np.uint8).reshape(-1, LENGTH)
        else:
            self.strings, self.string = np.empty((0, LENGTH), np.uint8), np.empty(0, np.int64)
        self.string_code = _code(self.strings)
        self.string_least = np.full(len(self.strings), np.iinfo(np.int64).max)
        np.minimum.at(self.string_least, self.string, self.ids[self.place_doc])

    def sent(self, buckets: int, string_buckets: int) -> Iterator[tuple[int, bytes, bytes]]:
        """Neighbourhoods by bucket, and strings by buckets with numbers below 0, each with the least ids."""
        for bucket, rows in _by_bucket(self.codes, buckets):
            yield bucket, self.records[rows].tobytes(), self.least[rows].tobytes()
        for bucket, rows in _by_bucket(self.string_code, string_buckets):
            yield -1 - bucket, self.strings[rows].tobytes(), self.string_least[rows].tobytes()

    def cut(self, buckets: int, string_buckets: int) -> Iterator[tuple]:
        """doc_id, hash of the text, bytes and runs removed, hash of the rest, where anything is removed."""
        gone = np.zeros(len(self.codes), np.uint64)
        answers = self._answers(2)
        for bucket, rows in _by_bucket(self.codes, buckets):
            if bucket in answers:
                gone[rows] = np.frombuffer(answers[bucket], np.uint64)
        fallen = np.zeros(len(self.strings), bool)
        for bucket, rows in _by_bucket(self.string_code, string_buckets):
            if -1 - bucket in answers:
                fallen[rows] = np.frombuffer(answers[-1 - bucket], bool)
        lost = (self.ids[self.place_doc] > self.string_least[self.string]) | fallen[self.string]
        # documents above the group's least id lose the whole neighbourhood's strings, which it has too
        strings = np.maximum(0, self.records[:, 1].astype(np.int64) - LENGTH + 1)
        every = (np.uint64(1) << strings.astype(np.uint64)) - np.uint64(1)
        above = self.ids[self.hit_doc] > self.least[self.hit]
        mask = np.where(above, every[self.hit], gone[self.hit])
        edges = np.zeros(len(self.data) + LENGTH + 1, np.int32)
        for o in range(LEFT + 1):
            at = self.hit_start[(mask >> np.uint64(o)) & np.uint64(1) > 0] + o
            edges[at] = 1
        edges[self.place[lost]] = 1
        # a string covers LENGTH bytes from its start
        starts = np.flatnonzero(edges)
        np.subtract.at(edges, starts + LENGTH, 1)
        covered = np.cumsum(edges)[: len(self.data)] > 0
        begin = np.concatenate([[0], self.ends]).tolist()
        for d in np.union1d(self.hit_doc[mask > 0], self.place_doc[lost]).tolist():
            text, gone = self.texts[d], covered[begin[d] : begin[d + 1]]
            runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
            kept = self.data[begin[d] : begin[d + 1]][~gone].tobytes()
            yield (
                int(self.ids[d]), hashlib.sha256(text).hexdigest(), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest(),
            )


def _code(rows: np.ndarray) -> np.ndarray:
    """A hash of each row of bytes."""
    width = -(-rows.shape[1] // 8) * 8
    words = np.zeros((len(rows), width), np.uint8)
    words[:, : rows.shape[1]] = rows
    code = np.zeros(len(rows), np.uint64)
    for k, word in enumerate(words.view(np.uint64).T):
        code = mix(code * _A + word + np.uint64(k))
    return code


def _by_bucket(codes: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of each bucket, in a fixed order."""
    home = (mix(codes) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(home, kind="stable")
    home = home[order]
    if len(home):
        cuts = np.flatnonzero(np.append(True, home[1:] != home[:-1]))
        for a, b in zip(cuts, [*cuts[1:], len(home)], strict=True):
            yield int(home[a]), order[a:b]


# ---- buckets -------------------------------------------------------------------------------------


def _shared_anchors(table: pa.Table, most: int) -> pa.Table:
    """For each group, which of the anchors it asks for another group has too, and which are hot: those with more
    than ``most`` neighbourhoods in all groups."""
    groups, blobs = table.column("grp").to_pylist(), table.column("keys").to_pylist()
    keys = np.frombuffer(b"".join(blobs), np.uint64)
    records, strings = (np.frombuffer(b"".join(table.column(c).to_pylist()), np.uint32).astype(np.int64) for c in ("records", "strings"))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    shared = np.zeros(len(keys), bool)
    shared[order[1:][same]] = True
    shared[order[:-1][same]] = True
    hot = np.zeros(len(keys), bool)
    if len(keys):
        first = np.flatnonzero(np.append(True, ~same))
        total = np.add.reduceat(records[order], first)
        hot[order] = np.repeat(total > most, np.diff(first, append=len(keys)))
    # what the groups send at most: an anchor of one document has one neighbourhood as a rule, and stays
    sends = shared | (records > 1)
    masks, hits, long, at = [], [], [], 0
    for blob in blobs:
        own = slice(at, at + len(blob) // 8)
        masks.append(b"".join(np.packbits(x[own], bitorder="little").tobytes() for x in (shared, hot)))
        hits.append(int(records[own][sends[own] & ~hot[own]].sum()))
        long.append(int(strings[own][hot[own]].sum()))
        at = own.stop
    return pa.table(
        {
            "grp": pa.array(groups, pa.int32()), "kind": pa.array([1] * len(groups), pa.int32()),
            "at": pa.array(table.column("bucket").to_pylist(), pa.int64()), "blob": pa.array(masks, pa.binary()),
            "hits": pa.array(hits, pa.int64()), "strings": pa.array(long, pa.int64()),
        }
    )


def _removed_strings(table: pa.Table) -> pa.Table:
    """For each group's neighbourhoods, a bit per string: does a document of smaller id have it; for strings, a byte of each."""
    if table.column("bucket")[0].as_py() < 0:
        return _removed_alone(table)
    records, leasts = (table.column(c).to_pylist() for c in ("records", "least"))
    size = RECORD.itemsize
    raw = np.frombuffer(b"".join(records), np.uint8).reshape(-1, size)
    least = np.frombuffer(b"".join(leasts), np.int64)
    rows = np.ascontiguousarray(raw).view(f"V{size}").ravel()
    distinct, which = np.unique(rows, return_inverse=True)
    flat = distinct.view(np.uint8).reshape(-1, size)
    low = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(low, which, least)
    sizes = flat[:, 1].astype(np.int64)
    values = np.unique(flat[:, 2:])
    if len(values) > 255:
        raise ValueError("texts must be UTF-8, which leaves byte values unused")
    rank = np.zeros(256, np.uint8)
    rank[values] = np.arange(1, len(values) + 1)
    cells = np.zeros((len(flat), SPAN + 1), np.uint8)
    inside = np.arange(SPAN)[None, :] < sizes[:, None]
    cells[:, :SPAN][inside] = rank[flat[:, 2:][inside]]
    keep = np.arange(SPAN + 1)[None, :] <= sizes[:, None]
    text = cells[keep]
    base = np.cumsum(sizes + 1) - (sizes + 1)
    order, run = equal_runs(text, suffix_array(text, LENGTH), LENGTH)
    owner = np.searchsorted(base, order, "right") - 1
    out = np.full((len(flat), LEFT + 1), np.iinfo(np.int64).max)
    if len(order):
        first = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
        out[owner, order - base[owner]] = np.minimum.reduceat(low[owner], first)[run]
    bits = (out[which] < least[:, None]).astype(np.uint64) << np.arange(LEFT + 1, dtype=np.uint64)
    masks = np.bitwise_or.reduce(bits, axis=1) if len(bits) else np.empty(0, np.uint64)
    blobs, at = [], 0
    for blob in leasts:
        blobs.append(masks[at : at + len(blob) // 8].tobytes())
        at += len(blob) // 8
    return _answered(table, blobs)


def _removed_alone(table: pa.Table) -> pa.Table:
    """For each group's strings, whether a document of smaller id has it."""
    records, leasts = (table.column(c).to_pylist() for c in ("records", "least"))
    least = np.frombuffer(b"".join(leasts), np.int64)
    distinct, which = np.unique(np.frombuffer(b"".join(records), f"V{LENGTH}"), return_inverse=True)
    low = np.full(len(distinct), np.iinfo(np.int64).max)
    np.minimum.at(low, which, least)
    fallen = low[which] < least
    blobs, at = [], 0
    for blob in leasts:
        blobs.append(fallen[at : at + len(blob) // 8].tobytes())
        at += len(blob) // 8
    return _answered(table, blobs)


def _answered(table: pa.Table, blobs: list[bytes]) -> pa.Table:
    n = table.num_rows
    return pa.table(
        {
            "grp": table.column("grp").cast(pa.int32()), "kind": pa.array([2] * n, pa.int32()),
            "at": table.column("bucket").cast(pa.int64()), "blob": pa.array(blobs, pa.binary()),
            "hits": pa.array([0] * n, pa.int64()), "strings": pa.array([0] * n, pa.int64()),
        }
    )


TOLD = "grp int, kind int, at long, blob binary, hits long, strings long"


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    light = written(
        texts.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")), "texts"
    )
    total = light.agg(F.sum("n_bytes")).first()[0]
    groups, askers = pieces(total, GROUP_BYTES), pieces(total, BUCKET_BYTES)
    reps = written(light.groupBy("sha").agg(F.min("doc_id").alias("rep")), "reps", light=True)
    group = F.pmod(F.hash("doc_id"), F.lit(groups)).alias("grp")
    held = f"quotelane_repeats_{uuid.uuid4().hex}"
    # bucketed by group, so that the passes below read it without a shuffle; beyond some 100 GB a
    # bucket has several groups, each still taken by itself
    parts = min(groups, MOST_TABLE_BUCKETS)
    try:
        (
            texts.where((F.octet_length("text") >= LENGTH) & F.col("doc_id").isNotNull())
            .select(group, "doc_id", "text")
            .repartition(parts, "grp")
            .write.format("parquet")
            .bucketBy(parts, "grp")
            .saveAsTable(held)
        )
        cuts = _cuts(spark.table(held), reps, groups, askers, total)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {held}")
    known = light.join(reps, "sha")
    copy = F.col("doc_id") > F.col("rep")
    whole = copy & (F.col("n_bytes") >= LENGTH)
    return known.join(cuts, (F.col("doc_id") == F.col("id")) & (F.col("sha") == F.col("cut_sha")) & ~copy, "left").select(
        "doc_id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
    )


def _cuts(held: DataFrame, reps: DataFrame, groups: int, askers: int, total: int | None) -> DataFrame:
    """What is cut of the texts of ``held``, a row per text; written, so ``held`` is needed no more."""
    grouped = held.groupBy("grp")
    own = reps.where("rep IS NOT NULL").select(
        F.pmod(F.hash("rep"), F.lit(groups)).alias("grp"), F.lit(0).alias("kind"), F.col("rep").alias("at"),
        F.lit(None).cast("binary").alias("blob"), F.lit(0).cast("long").alias("hits"), F.lit(0).cast("long").alias("strings"),
    )

    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        found = Group(left, right)
        sizes = found.counted()
        rows = [(b, *(x[r].tobytes() for x in (found.keys, *sizes))) for b, r in found.asked(askers)] if left.num_rows else []
        name = left.column("grp")[0].as_py() if left.num_rows else 0
        return pa.table(
            {
                "bucket": pa.array([r[0] for r in rows], pa.int32()), "grp": pa.array([name] * len(rows), pa.int32()),
                "keys": pa.array([r[1] for r in rows], pa.binary()), "records": pa.array([r[2] for r in rows], pa.binary()),
                "strings": pa.array([r[3] for r in rows], pa.binary()),
            }
        )

    most = BUCKET_BYTES // 8 // RECORD.itemsize

    def answer(asked: pa.Table) -> pa.Table:
        return _shared_anchors(asked, most)

    asked = grouped.cogroup(own.groupBy("grp")).applyInArrow(ask, "bucket int, grp int, keys binary, records binary, strings binary")
    shared = written(asked.groupBy("bucket").applyInArrow(answer, TOLD), "anchors", release=True)
    hits, strings = shared.agg(F.sum("hits"), F.sum("strings")).first()
    sorters = max(pieces((hits or 0) * SPAN, BUCKET_BYTES // 2), pieces(total, 8 * BUCKET_BYTES))
    alone = pieces((strings or 0) * LENGTH, BUCKET_BYTES)

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        found = Group(left, right)
        found.neighbourhoods(askers)
        rows = list(found.sent(sorters, alone))
        name = left.column("grp")[0].as_py() if left.num_rows else 0
        return pa.table(
            {
                "bucket": pa.array([r[0] for r in rows], pa.int32()), "grp": pa.array([name] * len(rows), pa.int32()),
                "records": pa.array([r[1] for r in rows], pa.binary()), "least": pa.array([r[2] for r in rows], pa.binary()),
            }
        )

    told = own.unionByName(shared)
    sent = grouped.cogroup(told.groupBy("grp")).applyInArrow(send, "bucket int, grp int, records binary, least binary")
    removed = written(sent.groupBy("bucket").applyInArrow(_removed_strings, TOLD), "strings", release=True)

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        found = Group(left, right)
        found.neighbourhoods(askers)
        columns = list(zip(*found.cut(sorters, alone), strict=True)) or [()] * 5
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
        names = ("id", "sha", "n_removed", "n_spans", "kept")
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)})

    cuts = grouped.cogroup(told.unionByName(removed).groupBy("grp")).applyInArrow(
        cut, "id long, sha string, n_removed long, n_spans long, kept string"
    )
    return written(cuts, "cuts").withColumnRenamed("sha", "cut_sha")
