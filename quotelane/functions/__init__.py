from quotelane.functions.columns import (  # noqa: F401
    event_time,
    market_value,
    signed_quantity,
    token_words,
    whitespace_words,
)
