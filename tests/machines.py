"""The pricing rules row by row in plain Python, to test the Spark forms against.

A row is (cusip, ord, timestamp, kind, account, quantity, price).
"""

from __future__ import annotations

import random


def random_rows(seed: int, cases: int, longest: int, step_ms: int = 1000, price_share: float = 0.4):
    """Rows of many securities, each a random case; arrival numbers are unique and rising."""
    rng = random.Random(seed)
    rows, number = [], 0
    lengths = {f"C{i}": rng.randint(1, longest) for i in range(cases)}
    order = [c for c, n in lengths.items() for _ in range(n)]
    rng.shuffle(order)
    clock = 0
    for cusip in order:
        number += rng.randint(1, 3)
        clock += rng.randint(0, 2) * step_ms
        is_price = rng.random() < price_share
        rows.append(
            (
                cusip,
                number,
                clock,
                "price" if is_price else "position",
                None if is_price else f"A{rng.randint(0, 2)}",
                None if is_price else rng.randint(-50, 50),
                round(rng.random() * 100, 2) if is_price else None,
            )
        )
    return rows


def _by_key(rows):
    keys = {}
    for row in sorted(rows, key=lambda r: r[1]):
        keys.setdefault(row[0], []).append(row)
    return keys


def single_slot(rows):
    """(cusip, account, quantity, price, ord)"""
    out = []
    for cusip, seq in _by_key(rows).items():
        waiting = kept = None
        for _, number, _, kind, account, quantity, price in seq:
            if kind == "position":
                if kept is not None:
                    out.append((cusip, account, quantity, kept, number))
                else:
                    waiting = (account, quantity)
            elif waiting is not None:
                out.append((cusip, *waiting, price, number))
                waiting = None
            else:
                kept = price
    return sorted(out)


def list_buffer(rows):
    """(cusip, account, quantity, price, ord, position's ord)"""
    out = []
    for cusip, seq in _by_key(rows).items():
        waiting = []
        for _, number, _, kind, account, quantity, price in seq:
            if kind == "position":
                waiting.append((account, quantity, number))
            else:
                out += [(cusip, a, q, price, number, n) for a, q, n in waiting]
                waiting = []
    return sorted(out)


def timer_conflation(rows, period):
    """(cusip, account, quantity, price, fire)"""
    out = []
    for cusip, seq in _by_key(rows).items():
        held, price_now, deadline = {}, None, None

        def fire():
            out.extend((cusip, a, q, price_now, deadline) for a, q in held.items())

        for _, _, at, kind, account, quantity, price in seq:
            if deadline is not None and at >= deadline:
                fire()
                held, price_now, deadline = {}, None, None
            if kind == "position":
                held[account] = quantity
            else:
                price_now = price
                if deadline is None:
                    deadline = at + period
        if deadline is not None:
            fire()
    return sorted(out)


def rolling(rows):
    """(cusip, ord, total) over position rows"""
    out = []
    for cusip, seq in _by_key(rows).items():
        total = 0
        for row in seq:
            if row[3] == "position":
                total += row[5]
                out.append((cusip, row[1], total))
    return sorted(out)
