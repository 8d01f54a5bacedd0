"""Pricing and running totals with the rows of one key spread over many tasks.

Running totals. Time is cut into buckets, and a key's buckets go round its shards. A shard sums up a
bucket of its own in order and tells all shards its total; each shard then adds to its rows the totals of all buckets
before. A bucket, which the clock bounds, is what one task holds of a key.

Single-slot pricing. Once a security has kept a price, each of its positions goes out at the latest price, which needs the prices and
the position alone. So positions are dealt into shards, and every shard has all prices. A shard
values its positions at the latest price before them, and says of each price which of its own positions
came last before it (a gap). Whether a position came between two prices, and which was last, is then decided from the
gaps of all shards: each shard gets them, finds the lock by itself, gives out what prices were spent
on if the position was its own, and drops its values from before the lock.

All steps take rows in order by ``streaming.held``. Rows are ordered by ``seq``, a text that sorts as
time, kind, partition and offset do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessorHandle

from quotelane.streaming import keyed
from quotelane.streaming.held import BUCKET_MS, run

SHARDS = 8
_SEQ = "seq STRING"


def _sorted_text(number: Column) -> Column:
    """A long as text that sorts as the number does."""
    return F.lpad(F.hex(number.cast("bigint").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")


def sequence(*numbers: str) -> Column:
    """Order of rows by time, positions before prices, then by the given numbers."""
    kind = F.when(F.col("kind") == "price", "1").otherwise("0")
    return F.concat(_sorted_text(F.col("timestamp")), kind, *[_sorted_text(F.col(n)) for n in numbers])


class ShardValues:
    """Values of a shard's positions at the latest price, and gaps, of rows in order."""

    def __init__(self, slot: str, bucket_ms: int) -> None:
        self.slot = slot
        self.names = keyed._names(slot)
        self.bucket_ms = bucket_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.price = handle.getValueState("price", "price DOUBLE")
        self.before = handle.getValueState("before", f"{self.slot}, position STRING")

    def ordered(self, key, batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
        is_price = batch["kind"] == "price"
        bucket = batch["timestamp"] // self.bucket_ms
        price = batch["price"].where(is_price).astype(float)
        latest = price.groupby(bucket).ffill()
        # what each bucket with a price leaves to those after it
        left = price[is_price].groupby(bucket[is_price]).tail(1)
        kept = [self.price.get()[0] if self.price.exists() else None, *left]
        carried = np.array(kept, dtype=float)[bucket[left.index].searchsorted(bucket)]
        latest = latest.fillna(pd.Series(carried, index=batch.index))
        values = batch.assign(price=latest, gap=False, position=None)[~is_price & latest.notna()]
        # the row before a price, if it is a position of this shard
        held = self.before.get() if self.before.exists() else None
        carried = [*self.names, "position"]
        whole = batch.assign(position=batch["seq"])
        before = whole[carried].astype(object).shift()
        after_position = (~is_price).shift(fill_value=held is not None)
        if held is not None:
            before.iloc[0] = list(held)
        before = before.where(after_position, None)
        gaps = batch.assign(gap=True, **{n: before[n] for n in carried})[is_price]
        if is_price.any():
            self.price.update((float(batch.loc[is_price, "price"].iloc[-1]),))
        last = whole.iloc[-1]
        if last["kind"] == "position":
            self.before.update((*keyed._slot(last, self.names), last["seq"]))
        else:
            self.before.clear()
        made = [rows for rows in (values, gaps) if len(rows)]
        if made:
            out = pd.concat(made)
            out.insert(0, "cusip", key[0])
            out.insert(1, "shard", key[1])
            out["quantity"] = out["quantity"].astype("Int32")
            yield out[["cusip", "shard", *self.names, "price", "gap", "position", "seq", "timestamp", "ts"]]


class LockedValues:
    """Of a shard's values and all shards' gaps, in order: what single-slot pricing gives out."""

    def __init__(self, slot: str) -> None:
        self.names = keyed._names(slot)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.locked = handle.getValueState("locked", "locked BOOLEAN")

    def ordered(self, key, batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
        made = []
        if not self.locked.exists():
            gaps = batch[batch["gap"]]
            # of all shards' gaps before a price, the one with the last position
            last = gaps.sort_values(["seq", "position"], na_position="first").drop_duplicates("seq", keep="last")
            empty = last.loc[last["position"].isna(), "seq"]
            lock = empty.min() if len(empty) else None
            spent = last if lock is None else last[last["seq"] < lock]
            made.append(spent[spent["origin"] == key[1]])
            if lock is None:
                batch = batch.iloc[0:0]
            else:
                self.locked.update((True,))
                batch = batch[batch["seq"] > lock]
        made.append(batch[~batch["gap"].astype(bool)])
        made = [rows for rows in made if len(rows)]
        if made:
            out = pd.concat(made).rename(columns={"seq": "ord"})
            out["cusip"] = key[0]
            out["quantity"] = out["quantity"].astype("Int32")
            yield out[["cusip", *self.names, "price", "ord", "timestamp", "ts"]]


def price_single_slot(
    events: DataFrame, slot: str = keyed.ACCOUNT_SLOT, shards: int = SHARDS, bucket_ms: int = BUCKET_MS,
    together: int = 1,
) -> DataFrame:
    """Single-slot pricing of rows in any order, a security's rows in ``shards`` parts.

    Events have ``seq`` (see ``sequence``) and a watermark on ``ts``; the result's ``ord`` is the ``seq`` of
    the row that caused a row.
    """
    everywhere = F.sequence(F.lit(0), F.lit(shards - 1))
    own = F.array(F.pmod(F.xxhash64("seq"), F.lit(shards)).cast("int"))
    dealt = events.withColumn("shard", F.explode(F.when(F.col("kind") == "price", everywhere).otherwise(own)))
    schema = f"cusip STRING, shard INT, {slot}, price DOUBLE, gap BOOLEAN, position STRING, {_SEQ}, timestamp BIGINT, ts TIMESTAMP"
    columns = f"kind STRING, price DOUBLE, {slot}"
    valued = run(dealt, ["cusip", "shard"], ShardValues(slot, bucket_ms), columns, _SEQ, schema, bucket_ms, together)
    # a shard needs every price once, and from the others those gaps that hold a position
    others = F.when(F.col("gap") & F.col("position").isNotNull(), everywhere).otherwise(F.array("shard"))
    told = valued.withColumn("origin", F.col("shard")).withColumn("shard", F.explode(others))
    columns = f"{slot}, price DOUBLE, gap BOOLEAN, position STRING, origin INT"
    schema = f"cusip STRING, {slot}, price DOUBLE, ord STRING, timestamp BIGINT, ts TIMESTAMP"
    return run(told, ["cusip", "shard"], LockedValues(slot), columns, _SEQ, schema, bucket_ms, together)


class BucketTotals:
    """Totals within each bucket for its rows, and a row for the bucket's total."""

    def __init__(self, bucket_ms: int) -> None:
        self.bucket_ms = bucket_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def ordered(self, key, batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
        out = batch.drop(columns=["account", "subAccount", "cusip"])
        bucket = batch["timestamp"] // self.bucket_ms
        # null until the first quantity, as a running sum is
        known = batch["quantity"].notna()
        total = batch["quantity"].where(known, 0).astype("int64").groupby(bucket).cumsum()
        out["total"] = total.astype("Int64").where(known.groupby(bucket).cummax())
        out["sums"] = False
        out = pd.concat([out, out.groupby(bucket).tail(1).assign(sums=True, quantity=None)])
        out.insert(0, "account", key[0])
        out.insert(1, "subAccount", key[1])
        out.insert(2, "cusip", key[2])
        out.insert(3, "shard", key[3])
        out["quantity"] = out["quantity"].astype("Int32")
        yield out[["account", "subAccount", "cusip", "shard", "quantity", "total", "sums", "seq", "timestamp", "ts"]]


class BasedTotals:
    """Totals over all buckets so far, of a shard's rows and the totals of all buckets."""

    def __init__(self, bucket_ms: int) -> None:
        self.bucket_ms = bucket_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.base = handle.getValueState("base", "base BIGINT")

    def ordered(self, key, batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
        base = self.base.get()[0] if self.base.exists() else None
        bucket = batch["timestamp"] // self.bucket_ms
        sums = batch["sums"].astype(bool)
        told = batch.loc[sums, "total"].dropna().astype("int64")
        # a total counts from the bucket after its own
        so_far = told.cumsum() + (base or 0)
        rows = batch[~sums]
        if len(rows):
            out = rows.rename(columns={"seq": "ord"}).assign(account=key[0], subAccount=key[1], cusip=key[2])
            before = bucket[told.index].searchsorted(bucket[rows.index])
            bases = pd.array([base, *so_far], dtype="Int64")[before]
            total = out["total"].astype("Int64")
            out["rollingQuantity"] = (total.fillna(0) + bases).where(~bases.isna(), total)
            out["quantity"] = out["quantity"].astype("Int32")
            yield out[["account", "subAccount", "cusip", "ord", "timestamp", "ts", "quantity", "rollingQuantity"]]
        if len(told):
            self.base.update((int(so_far.iloc[-1]),))


def rolling_quantity(
    positions: DataFrame, shards: int = SHARDS, bucket_ms: int = BUCKET_MS, together: int = 1
) -> DataFrame:
    """Running totals by account and security of rows in any order, a key's buckets dealt over ``shards``.

    Positions have ``seq`` and a watermark on ``ts``, as in ``price_single_slot``.
    """
    keys = ["account", "subAccount", "cusip", "shard"]
    bucket = F.floor(F.col("timestamp") / bucket_ms)
    dealt = positions.withColumn("shard", F.pmod(bucket, F.lit(shards)).cast("int"))
    columns = "account STRING, subAccount STRING, cusip STRING, quantity INT"
    schema = (
        f"account STRING, subAccount STRING, cusip STRING, shard INT, quantity INT, total BIGINT, sums BOOLEAN, {_SEQ}, "
        "timestamp BIGINT, ts TIMESTAMP"
    )
    summed = run(dealt, keys, BucketTotals(bucket_ms), columns, _SEQ, schema, bucket_ms, together)
    everywhere = F.sequence(F.lit(0), F.lit(shards - 1))
    told = summed.withColumn("shard", F.explode(F.when(F.col("sums"), everywhere).otherwise(F.array("shard"))))
    columns = "quantity INT, total BIGINT, sums BOOLEAN"
    schema = "account STRING, subAccount STRING, cusip STRING, ord STRING, timestamp BIGINT, ts TIMESTAMP, quantity INT, rollingQuantity BIGINT"
    return run(told, keys, BasedTotals(bucket_ms), columns, _SEQ, schema, bucket_ms, together)
