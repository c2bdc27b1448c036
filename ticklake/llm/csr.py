"""Sparse matrices in compressed rows, as far as the token alignment needs them."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np


class Csr(NamedTuple):
    """Row i has the columns ``cols[start[i]:start[i + 1]]`` with the values at the same places."""
    start: np.ndarray
    cols: np.ndarray
    values: np.ndarray
    width: int

    @property
    def height(self) -> int:
        return len(self.start) - 1


def runs(lengths: np.ndarray) -> Csr:
    """Row i covers the next ``lengths[i]`` columns: the incidence of tokens with the bytes they are cut from."""
    start = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
    width = int(start[-1])
    return Csr(start, np.arange(width, dtype=np.int64), np.ones(width, np.int32), width)


def one_each(cols: np.ndarray, width: int) -> Csr:
    """Row i has a one in column ``cols[i]``: the incidence of tokens with their group."""
    return Csr(np.arange(len(cols) + 1, dtype=np.int64), cols, np.ones(len(cols), np.int32), width)


def transposed(m: Csr) -> Csr:
    rows = np.repeat(np.arange(m.height, dtype=np.int64), np.diff(m.start))
    start = np.concatenate(([0], np.cumsum(np.bincount(m.cols, minlength=m.width), dtype=np.int64)))
    if np.all(m.cols[1:] >= m.cols[:-1]):
        return Csr(start, rows, m.values, m.height)
    order = np.argsort(m.cols, kind="stable")
    return Csr(start, rows[order], m.values[order], m.height)


def product_sizes(a: Csr, b: Csr) -> np.ndarray:
    """For each row of a, the entries that its row product with b adds up."""
    took = np.concatenate(([0], np.cumsum(np.diff(b.start)[a.cols], dtype=np.int64)))
    return took[a.start[1:]] - took[a.start[:-1]]


def row_products(a: Csr, b: Csr, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The entries (row, column, value) of a times b in row order, by Gustavson's rule.

    Row i of the product is the sum of b's rows at the columns of a's row i,
    each times a's value there. Rows are taken together while they add up
    ``most`` entries at most; a longer row is cut into parts of its columns
    and its sums are then added once more.
    """
    ends = np.cumsum(product_sizes(a, b))
    first = 0
    while first < a.height:
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + most, "right")))
        if ends[last - 1] - done <= most:
            yield _summed(*_expanded(a, b, first, last, a.start[first], a.start[last]), b.width)
        else:
            yield _long_row(a, b, first, most)
        first = last


def _long_row(a: Csr, b: Csr, row: int, most: int):
    """The product's row ``row`` from parts of a's entries."""
    lo, hi = int(a.start[row]), int(a.start[row + 1])
    ends = np.cumsum(np.diff(b.start)[a.cols[lo:hi]])
    parts, at = [], 0
    while at < hi - lo:
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + most, "right")))
        parts.append(_summed(*_expanded(a, b, row, row + 1, lo + at, lo + to), b.width))
        at = to
    return _summed(*(np.concatenate(p) for p in zip(*parts)), b.width)


def _expanded(a: Csr, b: Csr, first: int, last: int, lo: int, hi: int):
    """One (row, column, value) for each entry of b that a's entries lo to hi take."""
    cols = a.cols[lo:hi]
    rows = np.repeat(np.arange(first, last, dtype=np.int64),
                     np.diff(np.clip(a.start[first:last + 1], lo, hi)))
    n = np.diff(b.start)[cols]
    at = np.repeat(b.start[cols] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(int(n.sum()))
    return np.repeat(rows, n), b.cols[at], np.repeat(a.values[lo:hi], n) * b.values[at]


def _summed(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, width: int):
    """Values of the same row and column added up; ordered by row and column."""
    if not len(rows):
        return rows, cols, values
    key = rows * np.int64(width) + cols
    if not np.all(key[1:] >= key[:-1]):
        order = np.argsort(key, kind="stable")
        key, rows, cols, values = key[order], rows[order], cols[order], values[order]
    at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return rows[at], cols[at], np.add.reduceat(values, at)
