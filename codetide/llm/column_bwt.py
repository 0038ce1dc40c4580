"""Burrows-Wheeler transform and common prefixes of aligned byte strings, built column by column.

The strings of a collection are laid out so that equal places stand in one column.  From the last
column to the first, each round puts one symbol of every string in front of its suffix.  Where a suffix comes to
stand follows from where the shorter one stood, by counting: suffixes of equal first symbols keep
their order.  What two neighbours share follows from the least of the prefixes that lay between them.
So no suffix is ever compared with another, and a round reads the order and the prefixes of
the round before once, from front to back, and writes its own.

The transform is kept column by column: only suffixes that begin in one column are put in order
with each other, since strings are aligned and those of other columns are never asked for.  That makes a round as long as the
collection has strings, not symbols; a caller bounds them, and the two files of a round are kept in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

NONE = 0  # a string has no symbol in a column


def aligned(data: np.ndarray, lengths: np.ndarray, begins: np.ndarray, columns: int) -> np.ndarray:
    """Strings that lie end to end in ``data``, each from its own column on: a row per column, bytes counted from 1.

    A byte of 255 cannot be kept; UTF-8 has none.
    """
    layout = np.zeros((columns, len(lengths)), np.uint8)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    turn = np.arange(len(data)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    layout[begins[owner] + turn, owner] = data + np.uint8(1)
    return layout


def _range_min(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least of ``values`` between each ``low`` and ``high``, both included, from tables of doubling width."""
    width = high - low + 1
    power = np.frexp(width.astype(np.float64))[1] - 1
    tables = [values]
    for size in 1 << np.arange(int(power.max(initial=0))):
        last = tables[-1]
        wider = last.copy()
        np.minimum(last[:-size], last[size:], out=wider[:-size])
        tables.append(wider)
    table = np.concatenate(tables)
    at = power * len(values)
    return np.minimum(table[at + low], table[at + high - (1 << power) + 1])


def rounds(layout: np.ndarray, cap: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """From the last column: the column, its strings in the order of their suffixes from there on, and common prefixes.

    Entry ``k`` of the prefixes, up to ``cap``, is what the suffixes ``k - 1`` and ``k`` share.  A missing
    symbol comes before all others and is shared with none.
    """
    order = np.arange(layout.shape[1])
    common = np.zeros(len(order), np.uint8)
    for column in reversed(range(len(layout))):
        symbol = layout[column][order]
        moved = np.argsort(symbol, kind="stable")
        order, symbol = order[moved], symbol[moved]
        same = np.flatnonzero((symbol[1:] == symbol[:-1]) & (symbol[1:] != NONE)) + 1
        shared = np.zeros(len(order), np.uint8)
        shared[same] = np.minimum(_range_min(common, moved[same - 1] + 1, moved[same]) + np.uint8(1), cap)
        common = shared
        yield column, order, common
