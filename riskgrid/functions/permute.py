"""A keyed bijection on 0 .. n - 1: each row computes where its donor is.

The n positions are laid out as ``a`` columns of ``b`` rows (``a b >= n``, fewer than
``a`` places empty).  A Feistel step adds to one coordinate a hash of the other,
modulo its range, which any hash leaves reversible; ``ROUNDS`` steps mix both.  A
position that lands on an empty place goes through the steps again (cycle walking)
until it does not, so the whole is a bijection on the n positions.  The hash is
integer arithmetic modulo 2^31 - 1, so that other engines can follow it.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 6
PRIME = 2**31 - 1


def layout(n: int) -> tuple[int, int]:
    """(a, b) with ``a b >= n`` and ``a b - n < a``."""
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    return a, max(1, -(-n // a))


def round_keys(seed: int, rep: int) -> list[tuple[int, int, int]]:
    """Three numbers per step, of 2^15 .. 2^30 - 1 each."""
    out = []
    for r in range(ROUNDS):
        d = hashlib.md5(f"{seed}|permute|{rep}|{r}".encode()).digest()
        out.append(tuple(2**15 + int.from_bytes(d[4 * i:4 * i + 4]) % (2**30 - 2**15) for i in range(3)))
    return out


def bijection(pos: np.ndarray, n: int, keys: list[tuple[int, int, int]]) -> np.ndarray:
    """Where each position goes."""
    a, b = layout(n)

    def walk(x: np.ndarray) -> np.ndarray:
        left, right = x // b, x % b
        for r, (k0, k1, k2) in enumerate(keys):
            src = right if r % 2 == 0 else left
            t = (src % PRIME * k0 + k1) % PRIME
            t = (t * t + k2) % PRIME
            t = (t * (k0 ^ k2) + k1) % PRIME
            if r % 2 == 0:
                left = (left + t) % a
            else:
                right = (right + t) % b
        return left * b + right

    out = walk(pos.astype(np.int64))
    while (far := out >= n).any():
        out[far] = walk(out[far])
    return out


def donor_positions(pos: Column, n: int, seed: int, repeats: int) -> Column:
    """array<long>: the donor's position in each repeat."""
    keys = [round_keys(seed, r) for r in range(repeats)]

    @F.pandas_udf("array<long>")
    def donors(p: pd.Series) -> pd.Series:
        return pd.Series(list(np.column_stack([bijection(p.to_numpy(), n, k) for k in keys])))
    return donors(pos)
