"""Column expressions shared by the batch and streaming operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as blank.
BLANKS = " \t\n\x0b\f\r"


def event_time(epoch_ms: str | Column) -> Column:
    """Epoch milliseconds as a timestamp."""
    return F.timestamp_millis(F.col(epoch_ms) if isinstance(epoch_ms, str) else epoch_ms)


def signed_quantity(side: str | Column, quantity: str | Column) -> Column:
    """Quantity, negated unless the side is BUY; an absent side counts as a sale."""
    side = F.col(side) if isinstance(side, str) else side
    quantity = F.col(quantity) if isinstance(quantity, str) else quantity
    return F.when(side == "BUY", quantity).otherwise(-quantity)


def market_value(quantity: str | Column, price: str | Column) -> Column:
    quantity = F.col(quantity) if isinstance(quantity, str) else quantity
    price = F.col(price) if isinstance(price, str) else price
    return quantity * price


def whitespace_words(text: str | Column) -> Column:
    """Array of the pieces between single blanks.

    Empty pieces from leading or repeated blanks stay, trailing ones go. A text of blanks only
    has no pieces, the empty text has one empty piece.
    """
    text = F.col(text) if isinstance(text, str) else text
    kept = F.rtrim(text, F.lit(BLANKS))
    blank_only = (kept == "") & (text != "")
    return F.when(blank_only, F.array().cast("array<string>")).otherwise(F.split(kept, r"\s"))


def token_words(text: str | Column) -> Column:
    """Array of the lower-case ASCII word tokens, empties removed."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.lower(text), r"\W+"), "")
