"""Eigenvalues and eigenvectors of a symmetric matrix of whole numbers, to any precision.

The characteristic polynomial is exact: its coefficients modulo many primes come from
reduction to Hessenberg form modulo each prime, and Chinese remaindering puts them together.
All its roots are real, so the sign changes of its coefficients after a shift by ``a`` are
exactly its roots above ``a``, counted with multiplicity; bisection over dyadic numbers isolates
them and exact signs narrow them. Vectors come from inverse iteration on the matrix less the
root, which is a null space to the working precision, in decimal arithmetic.
"""

from __future__ import annotations

import decimal
import math
from fractions import Fraction

import numpy as np

#: primes are below 2^31, so that a product of two residues fits 63 bits
TOP = (1 << 31) - 1
#: decimal digits with which roots are narrowed and null spaces are solved
DIGITS = 100


def _is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide all numbers below 3 * 10^9."""
    if n < 2 or n % 2 == 0:
        return n == 2
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if n == base or x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_over(product: int) -> list[int]:
    """The largest primes up to ``TOP`` whose product is above ``product``."""
    found, n = [], TOP
    reached = 1
    while reached <= product:
        if _is_prime(n):
            found.append(n)
            reached *= n
        n -= 2
    return found


def coefficient_bound(matrix: list[list[int]]) -> int:
    """No coefficient of the characteristic polynomial is larger in absolute value.

    Coefficient k is a sum of the k * k principal minors, each at most the product of the
    norms of its rows, so all are at most the product of 1 + norm.
    """
    return math.prod(2 + math.isqrt(sum(v * v for v in row)) for row in matrix)


def hessenberg_polynomials(matrix: list[list[int]], primes: list[int]) -> np.ndarray:
    """Characteristic polynomial modulo every prime, all primes at once; row per prime,
    coefficients from the constant up to the leading 1."""
    n, k = len(matrix), len(primes)
    p = np.array(primes, np.int64)
    h = np.array([[[v % q for v in row] for row in matrix] for q in primes], np.int64).reshape(k, n, n)
    one, cube = p[:, None], p[:, None, None]
    every = np.arange(k)
    for j in range(n - 2):
        # the first entry below the diagonal that is not zero becomes the pivot
        below = h[:, j + 1 :, j] != 0
        pivot = np.where(below.any(1), below.argmax(1), 0) + j + 1
        first = h[every, pivot].copy()
        h[every, pivot] = h[:, j + 1]
        h[:, j + 1] = first
        first = h[every, :, pivot].copy()
        h[every, :, pivot] = h[:, :, j + 1]
        h[:, :, j + 1] = first
        inverse = np.array([pow(int(a), -1, int(q)) if a else 0 for a, q in zip(h[:, j + 1, j], p)], np.int64)
        u = h[:, j + 2 :, j] * inverse[:, None] % one
        h[:, j + 2 :] = (h[:, j + 2 :] - u[:, :, None] * h[:, j + 1][:, None, :] % cube) % cube
        # sums of up to n products: each reduced first
        h[:, :, j + 1] = (h[:, :, j + 1] + (h[:, :, j + 2 :] * u[:, None, :] % cube).sum(2)) % one
    made = [np.zeros((k, n + 1), np.int64)]
    made[0][:, 0] = 1
    for m in range(n):
        last = made[m]
        new = np.zeros_like(last)
        new[:, 1:] = last[:, :-1]
        new = (new - h[:, m, m][:, None] * last % one) % one
        chain = np.ones(k, np.int64)
        for i in range(m - 1, -1, -1):
            chain = chain * h[:, i + 1, i] % p
            if not chain.any():
                break
            new = (new - (h[:, i, m] * chain % p)[:, None] * made[i] % one) % one
        made.append(new)
    return made[n]


def remaindered(residues: list[tuple[int, list[int]]]) -> list[int]:
    """Whole numbers between minus and plus half the product of the primes, from residues."""
    product = math.prod(q for q, _ in residues)
    weights = [(product // q) * pow(product // q, -1, q) for q, _ in residues]
    out = []
    for k in range(len(residues[0][1])):
        v = sum(w * r[k] for w, (_, r) in zip(weights, residues)) % product
        out.append(v - product if 2 * v > product else v)
    return out


def _above(coefficients: list[int], at: int, bits: int) -> int:
    """Number of roots above ``at / 2^bits``: sign changes after the shift by it."""
    n = len(coefficients) - 1
    c = [v << (bits * (n - i)) for i, v in enumerate(coefficients)]  # of the roots times 2^bits
    if at:
        for i in range(n):
            for j in range(n - 1, i - 1, -1):
                c[j] += at * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _value(coefficients: list[int], at: int, bits: int) -> int:
    out, n = 0, len(coefficients) - 1
    for i in range(n, -1, -1):
        out = out * at + (coefficients[i] << (bits * (n - i)))
    return out


def largest_roots(coefficients: list[int], count: int, digits: int = DIGITS) -> list[tuple[Fraction, int]]:
    """The ``count`` largest positive roots and all equal to the last of them, falling, as
    ``(root, multiplicity)``, to a relative error of ``10^-digits``; all roots must be real
    and none negative. Roots that differ by less than that count as one.
    """
    rank = len(coefficients) - 1 - next(i for i, v in enumerate(coefficients) if v)
    coefficients = coefficients[len(coefficients) - 1 - rank :]  # without the roots that are 0
    if not rank:
        return []
    total = -coefficients[-2]  # of all roots, so at or above the largest
    # an interval is (low, high] in units of 2^-bits, with the number of roots in it
    open_intervals = [(0, total, 0, rank)]
    done: list[tuple[Fraction, int]] = []
    while open_intervals and sum(m for _, m in done) < count:
        low, high, bits, inside = open_intervals.pop()  # the highest one
        if inside == 1 and low:
            done.append((_narrowed(coefficients, low, high, bits, digits), 1))
            continue
        if low and (high - low) * 10**digits < low:
            done.append((Fraction(low + high, 2 << bits), inside))
            continue
        if high - low < 2:
            low, high, bits = low * 2, high * 2, bits + 1
        middle = (low + high) // 2
        upper = _above(coefficients, middle, bits) - _above(coefficients, high, bits)
        if inside > upper:
            open_intervals.append((low, middle, bits, inside - upper))
        if upper:
            open_intervals.append((middle, high, bits, upper))
    return done


def _narrowed(coefficients: list[int], low: int, high: int, bits: int, digits: int) -> Fraction:
    """The one root in ``(low, high]``. The sign of the polynomial tells its side; where it
    cuts the chord, the sides mostly close in by as many digits as they agree in."""
    at_high = _value(coefficients, high, bits)
    if not at_high:
        return Fraction(high, 1 << bits)
    side = at_high > 0
    width = 1
    while (high - low) * 10**digits >= low:
        if high - low < 1 << (width + 2):
            more = width + 3
            low, high, bits = low << more, high << more, bits + more
        a, b = _value(coefficients, low, bits), _value(coefficients, high, bits)
        if not b:
            return Fraction(high, 1 << bits)
        cells = 1 << width
        cell = (high - low) // cells
        k = min(cells - 1, max(0, (abs(a) * cells) // (abs(a) + abs(b)))) if a else 0
        left, right = low + k * cell, high if k == cells - 1 else low + (k + 1) * cell
        ahead = left == low or (_value(coefficients, left, bits) > 0) != side
        if ahead and (right == high or (_value(coefficients, right, bits) > 0) == side):
            low, high, width = left, right, width * 2
            continue
        middle = (low + high) // 2
        if (_value(coefficients, middle, bits) > 0) == side:
            high = middle
        else:
            low = middle
        width = max(1, width // 2)
    return Fraction(low + high, 2 << bits)


def null_vectors(matrix: list[list[int]], root: Fraction, count: int, digits: int = DIGITS) -> np.ndarray:
    """``count`` orthonormal vectors that the matrix stretches by ``root``, as float64 rows.

    Elimination with pivots of the matrix less the root, then inverse iteration: every step
    shrinks what lies outside of the null space by about ``10^digits`` times the distance to
    the next root. The largest entry of a vector is positive.
    """
    n = len(matrix)
    with decimal.localcontext() as context:
        context.prec = digits + 20
        context.Emax, context.Emin = decimal.MAX_EMAX, decimal.MIN_EMIN
        D = decimal.Decimal
        a = np.array([[D(v) for v in row] for row in matrix], object).reshape(n, n)
        scale = max((abs(v) for v in a.ravel()), default=D(1)) or D(1)
        shift = D(root.numerator) / D(root.denominator)
        for i in range(n):
            a[i, i] -= shift
        tiny = scale * D(10) ** -(digits + 10)
        order = np.arange(n)
        for j in range(n):
            pivot = j + int(np.argmax(np.abs(a[j:, j])))
            if pivot != j:
                a[[j, pivot]], order[[j, pivot]] = a[[pivot, j]], order[[pivot, j]]
            if abs(a[j, j]) < tiny:
                a[j, j] = tiny
            u = a[j + 1 :, j] / a[j, j]
            a[j + 1 :, j + 1 :] -= np.outer(u, a[j, j + 1 :])
            a[j + 1 :, j] = u
        random = np.random.default_rng(7)
        found: list[np.ndarray] = []
        for _ in range(count):
            v = np.array([D(int(x)) for x in random.integers(1, 1000, n)], object)
            for _ in range(3):
                x = v[order]
                for j in range(n):
                    x[j + 1 :] -= a[j + 1 :, j] * x[j]
                for j in range(n - 1, -1, -1):
                    x[j] = (x[j] - (a[j, j + 1 :] * x[j + 1 :]).sum()) / a[j, j]
                x = x / max(abs(y) for y in x)
                for _ in range(2):
                    for other in found:
                        x = x - other * (other * x).sum()
                v = x / (x * x).sum().sqrt()
            found.append(v)
        out = []
        for v in found:
            top = int(np.argmax(np.abs(v)))
            out.append([float(y if v[top] > 0 else -y) for y in v])
    return np.array(out, float).reshape(count, n)
