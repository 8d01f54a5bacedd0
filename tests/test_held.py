"""Keyed processors on state in memory: order, state read and written, and clocks."""

import random

import pandas as pd
import pyarrow as pa
import pytest

from quotelane.streaming import held, keyed, spread
from quotelane.streaming.clock import ClockWindows
from tests.fakes import Handle

SLOT = keyed.ACCOUNT_SLOT
COLUMNS = f"kind STRING, price DOUBLE, {SLOT}"


def _is_price(i):
    return i % 7 == 3 or i == 30  # two prices in a row at 31: from there on one is kept


def _rows(numbers, step=250):
    return pd.DataFrame(
        [
            {
                "timestamp": i * step, "kind": "price" if _is_price(i) else "position", "partition": i % 4, "offset": i,
                "price": float(i) if _is_price(i) else None, "account": "A", "subAccount": "S",
                "quantity": i, "orderId": str(i),
            }
            for i in numbers
        ]
    )


def _slot_handle():
    return Handle(held.Held(keyed.SingleSlot(SLOT), COLUMNS, held.MESSAGES, 10_000))


def _numbers(frames):
    return sorted((int(r["orderId"]), r["price"]) for f in frames for r in f.to_dict("records"))


def test_order_of_arrival_does_not_matter():
    whole = _slot_handle()
    expected = _numbers(whole.step(_rows(range(400))) + whole.step(watermark=10**9))
    assert len(expected) > 300
    for seed in range(5):
        numbers = list(range(400))
        random.Random(seed).shuffle(numbers)
        handle = _slot_handle()
        out = []
        for at in range(0, 400, 37):
            out += handle.step(_rows(numbers[at : at + 37]))
        assert _numbers(out + handle.step(watermark=10**9)) == expected


def test_rows_go_out_as_the_watermark_passes():
    handle = _slot_handle()
    out = []
    for i in range(0, 400, 10):
        out += handle.step(_rows(range(i, i + 10)), watermark=max(0, (i - 1) * 250))
        assert all(f["timestamp"].max() <= handle.clock.watermark for f in out)
    whole = _slot_handle()
    assert _numbers(out + handle.step(watermark=10**9)) == _numbers(whole.step(_rows(range(400))) + whole.step(watermark=10**9))


@pytest.mark.parametrize("triggers", [20, 40])
def test_a_side_that_runs_ahead_costs_its_rows_once(triggers):
    """The clock stands still while one side comes in: what waits is written once and not read."""
    handle = _slot_handle()
    each = 200
    for t in range(triggers):
        handle.step(_rows(range(t * each, (t + 1) * each)), watermark=0)
    rows = triggers * each
    assert handle.counts["read"] <= rows // 4
    assert handle.counts["written"] <= 2 * rows
    handle.step(watermark=10**9)
    assert handle.counts["read"] <= 2 * rows


def test_a_key_has_one_timer_for_all_that_waits():
    handle = _slot_handle()
    handle.step(_rows(range(4000)), watermark=0)
    assert len(handle.timers) == 1
    out = handle.step(watermark=500_000)
    assert max(f["timestamp"].max() for f in out) == 499_750
    assert len(handle.timers) == 1
    assert not handle.step(watermark=509_000)
    handle.step(watermark=10**9)
    assert not handle.timers


def _rows_out(frames):
    rows = pd.concat(frames).astype(object)
    return sorted(map(str, rows.where(rows.notna(), None).to_dict("records")))


TOTALS = "account STRING, subAccount STRING, cusip STRING, quantity INT"
CASES = {
    "slot": (lambda: keyed.SingleSlot(SLOT), COLUMNS, held.MESSAGES, ("X",)),
    "list": (lambda: keyed.ListBuffer(SLOT), COLUMNS, held.MESSAGES, ("X",)),
    "timer": (lambda: keyed.TimerConflation(3_000), COLUMNS, held.MESSAGES, ("X",)),
    "rolling": (keyed.RollingTotal, TOTALS, held.MESSAGES, ("A", "S", "X")),
    "shard values": (lambda: spread.ShardValues(SLOT, 10_000), COLUMNS, spread._SEQ, ("X", 1)),
    "bucket totals": (lambda: spread.BucketTotals(10_000), TOTALS, spread._SEQ, ("A", "S", "X", 1)),
}


@pytest.mark.parametrize("case", list(CASES))
def test_buckets_together_give_what_they_give_apart(case):
    inner, columns, order, key = CASES[case]
    rows = _rows(i for i in range(2000) if not 700 < i < 1100).assign(cusip="X", seq=lambda f: f["offset"].map("{:06d}".format))
    rows["account"] = [f"A{i % 3}" if i % 5 else None for i in rows["offset"]] if "kind" in columns else "A"
    rows.loc[rows["offset"] % 4 == 0, "quantity"] = None
    if case == "shard values":  # a price that is null at a bucket's end leaves none
        rows.loc[rows["offset"] % 3 == 0, "price"] = None
    found = []
    for together in (1, 6):
        for steps in ([10**9], [100_000, 333_333, 10**9]):
            handle = Handle(held.Held(inner(), columns, order, 10_000, together=together), key)
            handle.step(rows.sample(frac=1, random_state=1), watermark=0)
            out = [f for at in steps for f in handle.step(watermark=at)]
            found.append(_rows_out([f.drop(columns="ts") for f in out]))
            assert len(found[-1]) > 50
    assert all(f == found[0] for f in found)


def test_totals_of_several_buckets_at_once():
    rows = pd.DataFrame(
        [(5, "a", 1, 1, False), (5, "b", None, 1, True), (15_000, "c", None, None, False), (15_000, "d", None, None, True)]
        + [(25_000, "e", 2, 2, False), (26_000, "f", 3, 5, False), (26_000, "g", None, 5, True), (35_000, "h", 4, 4, False)],
        columns=["timestamp", "seq", "quantity", "total", "sums"],
    ).assign(ts=pd.Timestamp(0))
    handle = Handle(spread.BasedTotals(10_000), ("A", "S", "X", 1))
    (out,) = handle.processor.ordered(handle.key, rows)
    assert out["rollingQuantity"].tolist() == [1, 1, 3, 6, 10]
    assert handle.processor.base.get() == (6,)


def test_late_rows_come_out_again():
    names = ["cusip"]
    columns = ["cusip", "kind", "price", *keyed._names(SLOT), "partition", "offset", "ord", "timestamp", "ts", "late"]
    handle = Handle(held.Held(held.Passing(names), COLUMNS, held.MESSAGES, 10_000, (names, columns)))
    out = handle.step(_rows(range(100)), watermark=0)
    out += handle.step(_rows(range(100, 200)), watermark=20_000)
    out += handle.step(_rows(range(50, 60)), watermark=30_000)
    out += handle.step(watermark=10**9)
    rows = pd.concat(out)
    assert len(rows) == 210
    late = rows[rows["late"]]
    assert sorted(late["offset"]) == list(range(50, 60)) and late["ord"].isna().all()
    kept = rows[~rows["late"].astype(bool)].sort_values("ord")
    assert list(kept["offset"]) == list(range(200))


def test_fires_in_a_lull():
    """A timer that falls due without further rows fires, and so does one armed by rows released with it."""
    handle = Handle(held.Held(keyed.TimerConflation(60_000), COLUMNS, held.MESSAGES, 10_000))
    handle.step(_rows(range(5)))
    assert handle.step(watermark=30_000) == []
    (fire,) = handle.step(watermark=90_000)
    assert fire["timestamp"].tolist() == [3 * 250 + 60_000]
    handle.step(_rows([400, 401, 402, 403]))
    (fire,) = handle.step(watermark=10**9)
    assert fire["timestamp"].tolist() == [402 * 250 + 60_000]


FIELDS = "quantity INT, price DOUBLE, orderId STRING"
OUT = ["account", "quantity", "price", "orderId", "marketValue", "windowStart", "windowEnd", "timestamp", "late"]


def _priced(*rows):
    return pd.DataFrame([{"ord": o, "timestamp": t, "quantity": q, "price": p, "orderId": str(o)} for o, t, q, p in rows])


def test_window_of_the_clock_closes_by_the_clock():
    handle = Handle(ClockWindows(["account"], FIELDS, OUT, 60_000, None, False), ("A",))
    assert handle.step(_priced((1, 5, 10, 2.0), (2, 6, 20, 3.0)), now=1_000) == []
    # event times don't matter, and a later row of the window takes the earlier one's place
    assert handle.step(_priced((3, 99_000, 30, 4.0)), now=59_000) == []
    assert handle.step(_priced((4, 1, 40, 5.0)), now=60_000) == []
    (first,) = handle.step(now=60_001)
    assert first[["quantity", "marketValue", "windowEnd", "late"]].values.tolist() == [[30, 120.0, 60_000, False]]
    (second,) = handle.step(now=500_000)
    assert second[["quantity", "windowEnd"]].values.tolist() == [[40, 120_000]]


def test_lagging_clock_goes_on_in_a_lull():
    out = ["account", "quantity", "windowStart", "windowEnd", "timestamp", "late"]
    handle = Handle(ClockWindows(["account"], "quantity INT", out, 10_000, 5_000, True), ("A",))
    frame = pd.DataFrame({"timestamp": [1_000, 2_000, 12_000], "quantity": [1, 2, 4]})
    assert handle.step(frame, now=3_000) == []
    # quiet input: the clock alone closes the windows, five seconds after their ends
    assert handle.step(now=15_000) == []
    (first,) = handle.step(now=15_001)
    assert first[["quantity", "windowEnd"]].values.tolist() == [[3, 10_000]]
    (late,) = handle.step(pd.DataFrame({"timestamp": [9_999, 11_000], "quantity": [8, 16]}), now=15_002)
    assert late[["quantity", "windowEnd", "late"]].values.tolist() == [[8, 10_000, True]]
    (second,) = handle.step(now=30_000)
    assert second[["quantity", "windowEnd", "late"]].values.tolist() == [[20, 20_000, False]]


def test_totals_without_quantities_are_null():
    out = ["account", "quantity", "windowStart", "windowEnd", "timestamp", "late"]
    handle = Handle(ClockWindows(["account"], "quantity INT", out, 10_000, None, True), ("A",))
    handle.step(pd.DataFrame({"timestamp": [1], "quantity": [None]}), now=1)
    (found,) = handle.step(now=10_001)
    assert found["quantity"].isna().all()


def test_frames_of_one_micro_batch_share_a_stretch():
    frames = [_rows(range(i, 400, 40)) for i in range(40)]
    handle = _slot_handle()
    assert not list(handle.processor.handleInputRows(handle.key, iter(frames), handle.clock))
    # 100 seconds are ten buckets: one part each, and what the bucket holds; not one for every frame
    assert handle.counts["written"] == 20
    whole = _slot_handle()
    assert _numbers(handle.step(watermark=10**9)) == _numbers(whole.step(_rows(range(400))) + whole.step(watermark=10**9))


def test_long_numbers_stay_whole_beside_frames_with_nulls(monkeypatch):
    monkeypatch.setattr(held, "GATHERED", 1 << 40)
    rows = _rows(range(2)).assign(offset=[(1 << 60) + 1, (1 << 60) + 3], timestamp=5)
    other = _rows([2]).assign(offset=[None], timestamp=6).astype({"offset": float})
    handle = Handle(held.Held(held.Passing(["cusip"]), COLUMNS, held.MESSAGES, 10_000))
    list(handle.processor.handleInputRows(handle.key, iter([rows, other]), handle.clock))
    out = pd.concat(handle.step(watermark=10**9))
    assert [None if pd.isna(v) else int(v) for v in out["offset"]] == [(1 << 60) + 1, (1 << 60) + 3, None]


def _packets(frame, keys):
    """What a task's rows are packed into, as the processor gets it: a frame of packets for every key."""
    kinds = held._kinds(COLUMNS, held.MESSAGES)
    rows = {c: frame[c].astype(object).where(frame[c].notna(), None).tolist() for c in kinds}
    table = pa.table([*[pa.array(frame[k].tolist()) for k in keys], *rows.values()], [*[f"_k{i}" for i in range(len(keys))], *rows])
    packed = pa.concat_tables(pa.Table.from_batches([b]) for b in held.packer(keys, held._arrow(kinds))(iter(table.to_batches(1000))))
    return packed.to_pandas()


def test_rows_travel_as_a_packet_of_each_key():
    rows = _rows(range(4000)).assign(cusip=[("X", "Y", None)[i % 3] for i in range(4000)], shard=[i % 2 for i in range(4000)])
    packets = _packets(rows, ["cusip", "shard"])
    assert len(packets) == 6  # and not 4000 rows, each an object of its own
    inner = held.Held(keyed.SingleSlot(SLOT), COLUMNS, held.MESSAGES, 10_000, together=4, packed=True)
    plain = held.Held(keyed.SingleSlot(SLOT), COLUMNS, held.MESSAGES, 10_000, together=4)
    handle, other = Handle(inner), Handle(plain)
    out = handle.step(packets[(packets["cusip"] == "X") & (packets["shard"] == 0)])
    expected = other.step(rows[(rows["cusip"] == "X") & (rows["shard"] == 0)])
    found = _numbers(out + handle.step(watermark=10**9))
    assert len(found) > 300 and found == _numbers(expected + other.step(watermark=10**9))


def test_large_packets_are_cut(monkeypatch):
    monkeypatch.setattr(keyed, "CHUNK", 300)
    packets = _packets(_rows(range(1000)).assign(cusip="X"), ["cusip"])
    inner = held.Held(keyed.SingleSlot(SLOT), COLUMNS, held.MESSAGES, 10_000, packed=True)
    assert [len(t) for t in inner._tables(iter([packets]))] == [300, 300, 300, 100]


def test_packets_bring_nothing_to_buckets_that_are_given_out():
    handle = Handle(held.Held(keyed.SingleSlot(SLOT), COLUMNS, held.MESSAGES, 10_000, packed=True))
    first = handle.step(_packets(_rows(range(80)).assign(cusip="X"), ["cusip"]), watermark=10_005)
    assert max(f["timestamp"].max() for f in first) < 10_000
    late = _packets(_rows([5, 35, 70]).assign(cusip="X", orderId=["late", "late", "in time"], kind="position"), ["cusip"])
    ids = [i for f in handle.step(late, watermark=10**9) for i in f["orderId"]]
    assert "in time" in ids and "late" not in ids
