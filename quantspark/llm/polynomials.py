"""Exact eigenvalues of integer symmetric matrices.

The characteristic polynomial is found modulo primes (Hessenberg reduction, one
Spark row per prime) and put together by Chinese remaindering. All its roots are
real, so the number of roots above a point, each as often as it is repeated, is
the number of sign changes of the polynomial shifted there (Descartes' rule is
exact then). Bisection on that count encloses any root to any width. Vectors
come from inverse iteration on the matrix less the root, in decimal arithmetic.

All of this depends on the matrix alone, whose size is the vectors' width.
"""

from __future__ import annotations

import math
from decimal import Decimal, localcontext

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession

PRIME_TOP = 1 << 31
ROOT_BITS = 128
DIGITS = 120


def is_prime(n: int) -> bool:
    """Exact below 3,215,031,751 (strong probable primes to 2, 3, 5 and 7)."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7)):
        return n in (2, 3, 5, 7)
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for a in (2, 3, 5, 7):
        x = pow(a, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_for(bound: int) -> list[int]:
    """The largest primes under 2^31 whose product is over ``bound``."""
    out, product, n = [], 1, PRIME_TOP - 1
    while product <= bound:
        if is_prime(n):
            out.append(n)
            product *= n
        n -= 2
    return out


def polynomial_mod(m: np.ndarray, p: int) -> list[int]:
    """Coefficients, from the constant to the leading 1, of det(x - m) modulo p."""
    h, d = m.copy() % p, len(m)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1:, k])
        if not len(below):
            continue
        at = k + 1 + int(below[0])
        if at != k + 1:
            h[[at, k + 1]] = h[[k + 1, at]]
            h[:, [at, k + 1]] = h[:, [k + 1, at]]
        u = h[k + 2:, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2:] = (h[k + 2:] - u[:, None] * h[k + 1][None] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2:] * u[None] % p).sum(axis=1)) % p
    # the leading minors' polynomials, each from all before it
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(1, d + 1):
        row = np.zeros(d + 1, np.int64)
        row[1:] = polys[k - 1, :-1]
        factors, t = [int(h[k - 1, k - 1])], 1
        for i in range(1, k):
            t = t * int(h[k - i, k - i - 1]) % p
            factors.append(t * int(h[k - 1 - i, k - 1]) % p)
        f = np.array(factors, np.int64)[:, None]
        row = (row - (polys[k - 1::-1][:k] * f % p).sum(axis=0)) % p
        polys[k] = row
    return polys[d].tolist()


def remainders_joined(values: list[int], primes: list[int]) -> int:
    """The integer of least size with these remainders."""
    x, product = 0, 1
    for r, p in zip(values, primes):
        x += product * ((r - x) * pow(product, -1, p) % p)
        product *= p
    return x - product if 2 * x > product else x


def characteristic_polynomial(spark: SparkSession, m: list[list[int]]) -> list[int]:
    """Coefficients, from the constant to the leading 1, for a positive semidefinite ``m``."""
    d = len(m)
    trace = sum(m[i][i] for i in range(d))
    # elementary symmetric functions of roots that are not negative, by Maclaurin's inequality
    mean = -(-trace // d)
    primes = primes_for(2 * max(math.comb(d, k) * mean**k for k in range(d + 1)))
    flat = [x for row in m for x in row]

    def run(frames):
        whole = np.array(flat, object)
        for frame in frames:
            got = [polynomial_mod((whole % int(p)).astype(np.int64).reshape(d, d), int(p)) for p in frame["p"]]
            yield pd.DataFrame({"p": frame["p"], "c": got})

    rows = (spark.createDataFrame([(p,) for p in primes], "p long").repartition(min(len(primes), 64), "p")
            .mapInPandas(run, "p long, c array<long>").collect())  # some primes, each with d + 1 remainders
    by = {r.p: r.c for r in rows}
    return [remainders_joined([by[p][k] for p in primes], primes) for k in range(d + 1)]


def roots_above(poly: list[int], a: int, bits: int) -> int:
    """Roots over a / 2^bits, repeated ones as often as they are."""
    d = len(poly) - 1
    # falling powers of 2^bits * x, shifted by repeated synthetic division
    c = [poly[d - k] << (bits * k) for k in range(d + 1)]
    for i in range(d):
        for j in range(1, d + 1 - i):
            c[j] += a * c[j - 1]
    signs = [x > 0 for x in c if x]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def largest_roots(poly: list[int], how_many: int, top: int) -> list[int]:
    """The largest roots, falling, repeated ones as often as they are, for roots from 0 to
    ``top``: numerators over 2^ROOT_BITS, each root in (numerator - 1, numerator]."""
    known: dict[tuple[int, int], int] = {}

    def above(a, bits):
        if (a, bits) not in known:
            known[a, bits] = roots_above(poly, a, bits)
        return known[a, bits]

    out = []
    for j in range(1, how_many + 1):
        low, high = -1, top
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if above(mid, 0) >= j else (low, mid)
        for bits in range(1, ROOT_BITS + 1):
            low, high = 2 * low, 2 * high
            low, high = (low + 1, high) if above(low + 1, bits) >= j else (low, low + 1)
        out.append(high)
    return out


def _solver(m: list[list[int]], root: Decimal):
    """LU with partial pivoting of m - root; a pivot of nothing counts as a tiny one."""
    d = len(m)
    a = [[Decimal(x) for x in row] for row in m]
    for i in range(d):
        a[i][i] -= root
    order = list(range(d))
    tiny = Decimal(10) ** -(DIGITS * 3 // 4)
    for k in range(d):
        at = max(range(k, d), key=lambda r: abs(a[r][k]))
        a[k], a[at], order[k], order[at] = a[at], a[k], order[at], order[k]
        if not a[k][k]:
            a[k][k] = tiny
        pivot = a[k][k]
        for r in range(k + 1, d):
            if a[r][k]:
                f = a[r][k] = a[r][k] / pivot
                top, row = a[k], a[r]
                for c in range(k + 1, d):
                    row[c] -= f * top[c]

    def solve(b):
        y = [b[i] for i in order]
        for i in range(d):
            y[i] -= sum((a[i][c] * y[c] for c in range(i)), Decimal(0))
        for i in range(d - 1, -1, -1):
            y[i] = (y[i] - sum((a[i][c] * y[c] for c in range(i + 1, d)), Decimal(0))) / a[i][i]
        return y

    return solve


def _unit(v):
    size = sum(x * x for x in v).sqrt()
    return [x / size for x in v]


def eigenvectors(m: list[list[int]], roots: list[int]) -> np.ndarray:
    """Unit vectors, one row per root (numerators over 2^ROOT_BITS, falling). Vectors
    of equal roots are orthogonal; the largest component is positive."""
    d, out = len(m), []
    with localcontext() as context:
        context.prec = DIGITS
        before = None
        for root in roots:
            if root != before:
                same, before = [], root
                solve = _solver(m, Decimal(root) / Decimal(1 << ROOT_BITS))
            # a fixed start in general position, another one for each vector of a repeated root
            seed = 1 + len(same)
            v = [Decimal((seed * 7_368_787 + i * i * 1_299_709 + i * seed * 104_729) % 1_000_003 + 1) for i in range(d)]
            for _ in range(4):
                for w in same:
                    along = sum(x * y for x, y in zip(v, w))
                    v = [x - along * y for x, y in zip(v, w)]
                v = _unit(solve(_unit(v)))
            for w in same:
                along = sum(x * y for x, y in zip(v, w))
                v = [x - along * y for x, y in zip(v, w)]
            v = _unit(v)
            same.append(v)
            if max(v, key=abs) < 0:
                v = [-x for x in v]
            out.append([float(x) for x in v])
    return np.array(out).reshape(len(roots), d)


def square_root(root: int) -> float:
    """Of a numerator over 2^ROOT_BITS."""
    return math.isqrt(max(root, 0) << ROOT_BITS) / 2.0 ** ROOT_BITS
