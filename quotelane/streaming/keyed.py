"""Keyed-state processors: pricing and running totals as rows arrive.

Each processor keeps one security's (or account's) state. On its own it takes the rows of a key in
order from one micro-batch to the next, and sorts those of a micro-batch. Where rows come in any
order, ``streaming.held`` puts them in order first and hands them on by spans of time.

A key's rows of one micro-batch (or span) are held in memory by one task; bound the micro-batch at
the source (``maxBytesPerTrigger``, ``maxOffsetsPerTrigger``).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from quotelane.operators.conflation import PERIOD_MS

ACCOUNT_SLOT = "account STRING, subAccount STRING, quantity INT, orderId STRING"
SYMBOL_SLOT = "quantity INT"
# Rows given out at a time from a list of any length.
CHUNK = 10_000
_STAMP = "ord BIGINT, timestamp BIGINT, ts TIMESTAMP"
CONFLATED = f"cusip STRING, {ACCOUNT_SLOT}, price DOUBLE, marketValue DOUBLE, timestamp BIGINT, ts TIMESTAMP"
ROLLED = f"account STRING, subAccount STRING, cusip STRING, {_STAMP}, quantity INT, rollingQuantity BIGINT"


def priced_schema(slot: str) -> str:
    return f"cusip STRING, {slot}, price DOUBLE, {_STAMP}"


def listed_schema(slot: str) -> str:
    return f"cusip STRING, {slot}, price DOUBLE, marketValue DOUBLE, {_STAMP}, positionOrd BIGINT"


def _names(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.split(",")]


def _plain(value):
    """A value as the state store takes it."""
    if value is None or pd.isna(value):
        return None
    return value.item() if hasattr(value, "item") else value


def _slot(row, names: list[str]) -> tuple:
    values = [_plain(row[n]) for n in names]
    return tuple(int(v) if n == "quantity" and v is not None else v for n, v in zip(names, values, strict=True))


def _in_order(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(list(rows)).sort_values("ord", ignore_index=True)


class SingleSlot(StatefulProcessor):
    """One waiting position or one kept price per security."""

    def __init__(self, slot: str, ttl_ms: int | None = None) -> None:
        self.slot = slot
        self.names = _names(slot)
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.waiting = handle.getValueState("waiting", self.slot, self.ttl_ms)
        self.price = handle.getValueState("price", "price DOUBLE", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from self.ordered(key, _in_order(rows))

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        """A price to keep, or a position to wait; see ``operators.pricing.slot_state``."""
        for row in initialState.to_dict("records"):
            if row["kind"] == "price":
                self.price.update((float(row["price"]),))
            else:
                self.waiting.update(_slot(row, self.names))

    def ordered(self, key, batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
        priced = []
        if not self.price.exists():
            batch, spent = self._before_lock(batch)
            priced.append(spent)
        if self.price.exists() and len(batch):
            kept = self.price.get()[0]
            latest = batch["price"].where(batch["kind"] == "price").astype(float).ffill().fillna(kept)
            self.price.update((float(latest.iloc[-1]),))
            priced.append(batch.assign(price=latest)[batch["kind"] == "position"])
        priced = [rows for rows in priced if len(rows)]
        if priced:
            yield self._output(key[0], pd.concat(priced))

    def _before_lock(self, batch: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
        """Rows after the locking price, and the positions that prices before it were spent on."""
        is_price = batch["kind"] == "price"
        held = self.waiting.get() if self.waiting.exists() else None
        after_position = (~is_price).shift(fill_value=held is not None)
        locking = batch.index[is_price & ~after_position]
        head = batch if not len(locking) else batch.loc[: locking[0] - 1]
        before = head[self.names].astype(object).shift()
        if held is not None and len(head):
            before.iloc[0] = list(held)
        spent = head.assign(**{n: before[n] for n in self.names})[head["kind"] == "price"]
        if len(locking):
            self.waiting.clear()
            self.price.update((float(batch["price"].loc[locking[0]]),))
            return batch.loc[locking[0] + 1 :], spent
        if len(head):
            last = head.iloc[-1]
            if last["kind"] == "position":
                self.waiting.update(_slot(last, self.names))
            else:
                self.waiting.clear()
        return batch.iloc[0:0], spent

    def _output(self, cusip: str, rows: pd.DataFrame) -> pd.DataFrame:
        out = rows[[*self.names, "price", "ord", "timestamp", "ts"]].copy()
        out.insert(0, "cusip", cusip)
        out["quantity"] = out["quantity"].astype("Int32")
        return out


class ListBuffer(StatefulProcessor):
    """All positions wait for the security's next price."""

    def __init__(self, slot: str) -> None:
        self.slot = slot
        self.names = _names(slot)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.waiting = handle.getListState("waiting", f"{self.slot}, positionOrd BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from self.ordered(key, _in_order(rows))

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        """Positions to wait; see ``operators.pricing.list_state``."""
        rows = initialState.sort_values("ord").to_dict("records")
        self.waiting.appendList([(*_slot(row, self.names), int(row["ord"])) for row in rows])

    def ordered(self, key, batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
        is_price = batch["kind"] == "price"
        columns = [*self.names, "positionOrd"]
        stamps = ["price", "ord", "timestamp", "ts"]
        positions = batch[~is_price].rename(columns={"ord": "positionOrd"})[columns]
        prices = batch.loc[is_price, stamps]
        if len(prices):
            # all that waited so far came before the first price
            held = iter(self.waiting.get())
            while chunk := list(islice(held, CHUNK)):
                first = {c: prices[c].iloc[0] for c in stamps}
                yield self._valued(key[0], pd.DataFrame(chunk, columns=columns).assign(**first))
            self.waiting.clear()
            paired = pd.merge_asof(
                positions, prices, left_on="positionOrd", right_on="ord",
                direction="forward", allow_exact_matches=False,
            )
            valued = paired[paired["ord"].notna()]
            positions = paired.loc[paired["ord"].isna(), columns]
            if len(valued):
                yield self._valued(key[0], valued)
        if len(positions):
            self.waiting.appendList(
                [
                    (*_slot(row, self.names), int(row["positionOrd"]))
                    for row in positions.to_dict("records")
                ]
            )

    def _valued(self, cusip: str, rows: pd.DataFrame) -> pd.DataFrame:
        out = rows.assign(cusip=cusip, marketValue=rows["quantity"].astype(float) * rows["price"])
        out["quantity"] = out["quantity"].astype("Int32")
        longs = ["ord", "timestamp", "positionOrd"]
        out[longs] = out[longs].astype("int64")
        return out[["cusip", *self.names, "price", "marketValue", "ord", "timestamp", "ts", "positionOrd"]]


class TimerConflation(StatefulProcessor):
    """The latest position of every account slot, valued when the security's timer fires.

    Timers fire only after a micro-batch's rows are in, so rows at or past the deadline fire it
    first; the registered timer serves keys that have gone quiet.
    """

    def __init__(self, period_ms: int) -> None:
        self.period_ms = period_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getMapState(
            "held", "account STRING, subAccount STRING", "quantity INT, orderId STRING"
        )
        self.price = handle.getValueState("price", "price DOUBLE")
        self.deadline = handle.getValueState("deadline", "at BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from self.ordered(key, pd.concat(list(rows)).sort_values(["timestamp", "ord"], ignore_index=True))

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        """The rows since the last fire, as they came; see ``operators.conflation.timer_state``."""
        for _ in self.ordered(key, initialState.sort_values(["timestamp", "ord"], ignore_index=True)):
            raise ValueError("initial rows reach past a fire")

    def ordered(self, key, batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
        at = batch["timestamp"].to_numpy()
        is_price = (batch["kind"] == "price").to_numpy()
        prices = is_price.nonzero()[0]
        armed = deadline = self.due()
        fires, ends, start = [], [], 0
        while start < len(batch):
            if deadline is None:
                arming = prices.searchsorted(start)
                if arming == len(prices):
                    break
                deadline = int(at[prices[arming]]) + self.period_ms
            start = max(start, int(at.searchsorted(deadline)))
            if start < len(batch):
                fires.append(deadline)
                ends.append(start)
                deadline = None
        if fires:
            if armed is not None:
                self.wait_no_more(armed)
            # how many of the fires come before a row
            past = np.searchsorted(ends, np.arange(len(batch)), side="right")
            yield from self._fires(key[0], batch[past < len(fires)], past[past < len(fires)], np.array(fires))
            batch = batch[past == len(fires)]
        self._hold(batch)
        if deadline is not None and (fires or deadline != armed):
            self.deadline.update((deadline,))
            self.wait_until(deadline)

    def wait_until(self, deadline: int) -> None:
        self.handle.registerTimer(deadline)

    def wait_no_more(self, deadline: int) -> None:
        self.handle.deleteTimer(deadline)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        if self.deadline.exists() and self.deadline.get()[0] == at:
            yield from self._fire(key[0], at)

    def due(self) -> int | None:
        return self.deadline.get()[0] if self.deadline.exists() else None

    def passed(self, key) -> Iterator[pd.DataFrame]:
        yield from self._fire(key[0], self.due())

    def _hold(self, rows: pd.DataFrame) -> None:
        prices = rows[rows["kind"] == "price"]
        if len(prices):
            self.price.update((float(prices["price"].iloc[-1]),))
        positions = rows[rows["kind"] == "position"]
        for row in positions.drop_duplicates(["account", "subAccount"], keep="last").to_dict("records"):
            self.held.updateValue(
                _slot(row, ["account", "subAccount"]), _slot(row, ["quantity", "orderId"])
            )

    def _fire(self, cusip: str, at: int) -> Iterator[pd.DataFrame]:
        none = pd.DataFrame(columns=["kind", *_names(ACCOUNT_SLOT), "price"])
        yield from self._fires(cusip, none, np.array([], dtype="int64"), np.array([at]))

    def _fires(self, cusip: str, rows: pd.DataFrame, past: np.ndarray, fires: np.ndarray) -> Iterator[pd.DataFrame]:
        """What the fires give out, of what is held and the rows up to the last fire; ``past`` numbers each row's fire."""
        slot, names = ["account", "subAccount"], ["account", "subAccount", "quantity", "orderId"]
        # a snapshot, as the store is cleared before the rows go out
        held = pd.DataFrame([(*s, *position) for s, position in self.held.iterator()], columns=names, dtype=object)
        price = self.price.get()[0] if self.price.exists() else None
        self.held.clear()
        self.price.clear()
        self.deadline.clear()
        is_price = (rows["kind"] == "price").to_numpy()
        quotes = pd.Series(price, index=[0], dtype=float)
        quotes = pd.concat([quotes, rows["price"][is_price].astype(float).set_axis(past[is_price])])
        latest = quotes[~quotes.index.duplicated(keep="last")]
        positions = rows.loc[~is_price, names].astype(object).assign(_fire=past[~is_price])
        out = pd.concat([held.assign(_fire=0), positions]).drop_duplicates(["_fire", *slot], keep="last")
        if len(out):
            number = out.pop("_fire").astype("int64").to_numpy()
            out.insert(0, "cusip", cusip)
            quantity = out["quantity"].astype(float)
            out["price"] = latest.reindex(number).to_numpy()
            out["marketValue"] = quantity * out["price"]
            out["quantity"] = quantity.astype("Int32")
            out["timestamp"] = fires[number]
            out["ts"] = pd.to_datetime(out["timestamp"], unit="ms")
            yield out


class RollingTotal(StatefulProcessor):
    """The key's total so far, for every row."""

    def __init__(self, ttl_ms: int | None = None) -> None:
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "total BIGINT", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from self.ordered(key, _in_order(rows))

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        """The total so far, in ``rollingQuantity``; none where it is null."""
        so_far = _plain(initialState["rollingQuantity"].iloc[0])
        if so_far is not None:
            self.total.update((int(so_far),))

    def ordered(self, key, batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
        before = self.total.get()[0] if self.total.exists() else None
        # null until the first quantity, as a running sum is
        known = batch["quantity"].notna().cummax() | (before is not None)
        total = batch["quantity"].fillna(0).astype("int64").cumsum() + (before or 0)
        batch["rollingQuantity"] = total.astype("Int64").where(known)
        if known.iloc[-1]:
            self.total.update((int(total.iloc[-1]),))
        batch["quantity"] = batch["quantity"].astype("Int32")
        yield batch[
            ["account", "subAccount", "cusip", "ord", "timestamp", "ts", "quantity", "rollingQuantity"]
        ]


def _time(ttl_ms: int | None) -> tuple[str, str]:
    """Time mode and event-time column. State lives by the wall clock where it expires, so no
    event-time operator can follow then."""
    return ("eventTime", "ts") if ttl_ms is None else ("processingTime", "")


def _initial(state: DataFrame | None, *keys: str):
    return None if state is None else state.groupBy(*keys)


def price_single_slot(
    events: DataFrame, slot: str = ACCOUNT_SLOT, ttl_ms: int | None = None, initial: DataFrame | None = None
) -> DataFrame:
    """Streaming form of ``operators.pricing.price_single_slot``; events carry a watermark on ``ts``.

    With ``ttl_ms``, what a security holds is forgotten that long after it was last set. ``initial`` is what
    a batch run left (``slot_state``): the stream goes on from there.
    """
    mode, column = _time(ttl_ms)
    return events.groupBy("cusip").transformWithStateInPandas(
        SingleSlot(slot, ttl_ms),
        priced_schema(slot),
        "append",
        mode,
        initialState=_initial(initial, "cusip"),
        eventTimeColumnName=column,
    )


def price_list_buffer(events: DataFrame, slot: str = ACCOUNT_SLOT, initial: DataFrame | None = None) -> DataFrame:
    return events.groupBy("cusip").transformWithStateInPandas(
        ListBuffer(slot),
        listed_schema(slot),
        "append",
        "eventTime",
        initialState=_initial(initial, "cusip"),
        eventTimeColumnName="ts",
    )


def price_timer_conflation(
    events: DataFrame, period_ms: int = PERIOD_MS, initial: DataFrame | None = None
) -> DataFrame:
    return events.groupBy("cusip").transformWithStateInPandas(
        TimerConflation(period_ms),
        CONFLATED,
        "append",
        "eventTime",
        initialState=_initial(initial, "cusip"),
        eventTimeColumnName="ts",
    )


def rolling_quantity(
    positions: DataFrame, ttl_ms: int | None = None, initial: DataFrame | None = None
) -> DataFrame:
    mode, column = _time(ttl_ms)
    keys = ["account", "subAccount", "cusip"]
    # a row without key, such as a replay's closing row, takes no part, as in the batch form
    return positions.dropna(subset=keys).groupBy(*keys).transformWithStateInPandas(
        RollingTotal(ttl_ms),
        ROLLED,
        "append",
        mode,
        initialState=_initial(initial, *keys),
        eventTimeColumnName=column,
    )
