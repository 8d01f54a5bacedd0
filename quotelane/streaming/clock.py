"""Windows closed by the clock, not by event time.

Two rules, each an operator of its own beside the event-time windows:

- ``by_arrival``: a row belongs to the window of the clock at its arrival, and the window goes out when
  the clock passes its end.
- ``by_lag``: a row belongs to the window of its own time; the watermark is the clock less a lag. A
  window goes out when the lagging clock has passed it, a row whose window is gone is late and goes
  out by itself, flagged. In a lull the clock goes on, so the last windows close without further rows.

Open windows are kept in a map state by their end, and a timer per end closes them. The clock is that
of the micro-batch: all rows of one arrive at the same time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from quotelane.operators import windows
from quotelane.streaming.keyed import _plain

LAG_MS = 5_000


class ClockWindows(StatefulProcessor):
    """One row per key and window: the last of each field by ``ord``, or the sum of ``quantity``."""

    def __init__(self, keys: Sequence[str], fields: str, columns: Sequence[str], width_ms: int, lag_ms: int | None, total: bool):
        self.keys = list(keys)
        self.fields = fields
        self.names = [part.split()[0] for part in fields.split(",")]
        self.columns = list(columns)
        self.width_ms, self.lag_ms, self.total = width_ms, lag_ms, total

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        kept = "quantity BIGINT" if self.total else f"ord BIGINT, {self.fields}"
        self.open = handle.getMapState("open", "windowEnd BIGINT", kept)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        for frame in rows:
            if self.lag_ms is None:
                ends = pd.Series(now // self.width_ms * self.width_ms + self.width_ms, index=frame.index)
            else:
                ends = frame["timestamp"] // self.width_ms * self.width_ms + self.width_ms
                late = ends - 1 <= now - self.lag_ms
                if late.any():
                    yield self._out(key, frame[late].assign(windowEnd=ends[late], late=True))
                    frame, ends = frame[~late], ends[~late]
            for end, part in frame.groupby(ends):
                self._keep((int(end),), part)
                self.handle.registerTimer(int(end) + (self.lag_ms or 0))

    def _keep(self, end: tuple[int], part: pd.DataFrame) -> None:
        held = self.open.getValue(end) if self.open.containsKey(end) else None
        if self.total:
            known = part["quantity"].dropna()
            before = held[0] if held else None
            after = before if not len(known) else int(known.sum()) + (before or 0)
            self.open.updateValue(end, (after,))
            return
        last = part.sort_values("ord").iloc[-1]
        if held is None or held[0] < last["ord"]:
            row = [_plain(last[n]) for n in self.names]
            whole = {n for n, kind in (p.split() for p in self.fields.split(",")) if kind in ("INT", "BIGINT")}
            row = [int(v) if n in whole and v is not None else v for n, v in zip(self.names, row, strict=True)]
            self.open.updateValue(end, (int(last["ord"]), *row))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = (expiredTimerInfo.getExpiryTimeInMs() - (self.lag_ms or 0),)
        if self.open.containsKey(end):
            held = self.open.getValue(end)
            self.open.removeKey(end)
            row = dict(zip(["quantity"] if self.total else ["ord", *self.names], held, strict=True))
            yield self._out(key, pd.DataFrame([{**row, "windowEnd": end[0], "late": False}]))

    def _out(self, key, rows: pd.DataFrame) -> pd.DataFrame:
        out = rows.assign(**dict(zip(self.keys, key, strict=True)))
        out["windowStart"] = out["windowEnd"] - self.width_ms
        out["timestamp"] = out["windowEnd"]
        if "price" in self.names:
            out["marketValue"] = out["quantity"].astype(float) * out["price"].astype(float)
        out["quantity"] = out["quantity"].astype("Int64" if self.total else "Int32")
        return out.reindex(columns=self.columns)


def _run(
    rows: DataFrame, keys: Sequence[str], fields: str, width_ms: int, lag_ms: int | None, total: bool = False
) -> DataFrame:
    columns = [f"{k} STRING" for k in keys]
    if total:
        columns.append("quantity BIGINT")
    else:
        columns += [p.strip() for p in fields.split(",")]
        if "price" in fields:
            columns.append("marketValue DOUBLE")
    columns += ["windowStart BIGINT", "windowEnd BIGINT", "timestamp BIGINT", "late BOOLEAN"]
    names = [c.split()[0] for c in columns]
    processor = ClockWindows(keys, fields, names, width_ms, lag_ms, total)
    return rows.groupBy(*keys).transformWithStateInPandas(processor, ", ".join(columns), "append", "processingTime")


def last_value(
    priced: DataFrame,
    keys: Sequence[str] = windows.ACCOUNT_KEY,
    fields: str = "quantity INT, price DOUBLE, orderId STRING",
    width_ms: int = 60_000,
    lag_ms: int | None = None,
) -> DataFrame:
    """The last priced position per key and window of the clock (of the lagging clock, with ``lag_ms``)."""
    return _run(priced, keys, fields, width_ms, lag_ms)


def total(
    positions: DataFrame,
    keys: Sequence[str] = windows.ACCOUNT_KEY,
    width_ms: int = 10_000,
    lag_ms: int | None = None,
) -> DataFrame:
    """The sum of quantities per key and window of the clock; late rows go out with their own quantity."""
    return _run(positions, keys, "quantity INT", width_ms, lag_ms, total=True)
