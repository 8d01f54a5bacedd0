"""Word counts by packets, on state in memory."""

import collections

import pandas as pd
import pyarrow as pa
import pytest

from quotelane.streaming import counts
from tests.fakes import Handle

WIDTH, TOGETHER = 5_000, 4


def _packets(rows, each=100):
    """Packets of rows (window's start, word) by stretch and slot, as a task makes them."""
    table = pa.table({"start": pa.array([s for s, _ in rows], pa.int64()), "word": [w for _, w in rows]})
    made = collections.defaultdict(list)
    for batch in counts.counter(WIDTH, TOGETHER)(iter(table.to_batches(max_chunksize=each))):
        for row in batch.to_pylist():
            made[row["stretch"], row["slot"]].append(row["rows"])
    return made


def _given(frames):
    out = collections.Counter()
    for frame in frames:
        for start, end, word, count in frame.itertuples(index=False):
            assert end == start + WIDTH
            assert (start, word) not in out
            out[start, word] = count
    return out


@pytest.mark.parametrize("gathered", [10, 10_000])
def test_packets_of_several_tasks_are_counted_together(monkeypatch, gathered):
    monkeypatch.setattr(counts, "GATHERED", gathered)
    tasks = [[(5_000 * (i % 7) - 10_000, f"w{i * k % 31}") for i in range(500)] for k in (1, 2, 3)]
    tasks.append([(0, ""), (0, "\u00e9\U0001f600"), (0, "a" * 70_000)])
    arrived = collections.defaultdict(list)
    for rows in tasks:
        for key, packets in _packets(rows).items():
            arrived[key].append(packets)
    assert {slot for _, slot in arrived} == set(range(counts.SLOTS))
    out = []
    for key, batches in arrived.items():
        handle = Handle(counts.Stretch(WIDTH, TOGETHER), key)
        for packets in batches:
            assert handle.step(pd.DataFrame({"rows": packets}), watermark=-60_000) == []
        assert handle.step(watermark=key[0] + WIDTH * TOGETHER - 1) == []  # the last window is not over
        out += handle.step(watermark=key[0] + WIDTH * TOGETHER)
        assert not handle.processor.rows.rows and not handle.timers
    assert _given(out) == collections.Counter(row for rows in tasks for row in rows)


def test_a_word_that_repeats_is_one_count_a_task(monkeypatch):
    monkeypatch.setattr(counts, "GATHERED", 1_000)
    made = _packets([(0, f"w{i % 3}") for i in range(50_000)], each=500)
    assert sum(len(packets) for packets in made.values()) <= 3


def test_late_packets_are_left_out():
    (key, packets), = _packets([(0, "a")]).items()
    handle = Handle(counts.Stretch(WIDTH, TOGETHER), key)
    handle.step(pd.DataFrame({"rows": packets}))
    assert _given(handle.step(watermark=WIDTH * TOGETHER)) == {(0, "a"): 1}
    assert handle.step(pd.DataFrame({"rows": packets})) == []
    assert handle.step(watermark=10**6) == [] and not handle.processor.rows.rows
