"""Indel similarity (0-100) of two strings as native Spark expressions.

ratio(a, b) = 200 * LCS(a, b) / (len(a) + len(b)), where LCS is the longest common
subsequence, case-sensitive and without preprocessing; two empty strings score 100.

Two exact LCS forms, both built from higher-order functions (no Python):
  * ``lcs_bits``: bit-parallel LCS (Allison-Dix / Hyyro): one 64-bit word holds a DP row of
    ``b`` (up to 62 characters); per character ``c`` of ``a``:
    U = V & M[c];  V = ((V + U) | (V - U)) & full;  LCS = |b| - popcount(V).
    The match masks M of ``b`` are built once per distinct ``b`` and reused for every alias,
    so a pair costs |a| steps instead of |a|*|b|;
  * ``lcs_length``: the plain DP with nested ``aggregate``, for longer strings.
They are meant for the small header x alias side of the resolver, never for data rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from driftsweep.schema import SCORE_THRESHOLD


def _chars(s: Column) -> Column:
    # code-point characters (Spark strings index by code point, like Python)
    return F.transform(F.sequence(F.lit(1), F.char_length(s)), lambda i: F.substr(s, i, F.lit(1)))


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of ``a`` and ``b`` (int)."""
    n = F.char_length(b)

    def next_row(prev: Column, ch: Column) -> Column:
        # cur[j] = prev[j-1] + 1 if a_i == b_j else max(prev[j], cur[j-1])   (0-based)
        return F.aggregate(
            F.sequence(F.lit(1), n),
            F.array(F.lit(0)),
            lambda cur, j: F.concat(cur, F.array(
                F.when(ch == F.substr(b, j, F.lit(1)), F.element_at(prev, j) + 1)
                .otherwise(F.greatest(F.element_at(prev, j + 1), F.element_at(cur, j))))),
        )

    dp = F.aggregate(_chars(a), F.array_repeat(F.lit(0), n + 1), next_row, lambda p: F.element_at(p, -1))
    return F.when((F.char_length(a) == 0) | (n == 0), F.lit(0)).otherwise(dp)


MAX_BITS = 62  # V + U stays below 2^63: no overflow under ANSI arithmetic


def _bit(j: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), j)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once a row. An expression inside a lambda is worked out at each of its
    steps, also one that comes from another column, as the planner may put that column's expression in its place."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def char_masks(b: Column) -> Column:
    """map<char, long>: bit j set where the j-th character of ``b`` is that char."""
    n = F.char_length(b)

    def masks(chars: Column) -> Column:
        def mask(c: Column) -> Column:
            return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0).cast("long"),
                               lambda m, j: F.when(F.get(chars, j) == c, m.bitwiseOR(_bit(j))).otherwise(m))

        return F.map_from_entries(F.transform(F.array_distinct(chars), lambda c: F.struct(c, mask(c))))

    return F.when((n > 0) & (n <= MAX_BITS), _once(_chars(b), masks))


def lcs_bits(a: Column, b_len: Column, masks: Column) -> Column:
    """LCS length of ``a`` and a string of length ``b_len`` <= 62 with match masks ``masks``."""
    full = _bit(b_len) - 1

    def step(v: Column, c: Column) -> Column:
        u = v.bitwiseAND(F.coalesce(F.element_at(masks, c), F.lit(0).cast("long")))
        return (v + u).bitwiseOR(v - u).bitwiseAND(full)

    v = F.aggregate(_chars(a), full, step)
    return (b_len - F.bit_count(v)).cast("int")


def lcs_fast(a: Column, b: Column, masks: Column) -> Column:
    """Exact LCS: bit-parallel when ``b`` fits in one word, DP otherwise."""
    n = F.char_length(b)
    return (F.when((F.char_length(a) == 0) | (n == 0), F.lit(0))
             .when(n <= MAX_BITS, _once(masks, lambda m: lcs_bits(a, n, m)))
             .otherwise(lcs_length(a, b)))


def indel_ratio(a: Column, b: Column, lcs: Column | None = None) -> Column:
    """Similarity score 0..100 as a double (exact IEEE division of integers)."""
    lcs = lcs_length(a, b) if lcs is None else lcs
    total = F.char_length(a) + F.char_length(b)
    return F.when(total == 0, F.lit(100.0)).otherwise(
        (F.lit(200) * lcs).cast("double") / total.cast("double"))


def passes_threshold(a: Column, b: Column, lcs: Column) -> Column:
    """score > 80 decided on integers: 200*lcs/(la+lb) > 80  <=>  5*lcs > 2*(la+lb)."""
    total = F.char_length(a) + F.char_length(b)
    return F.when(total == 0, F.lit(100 > SCORE_THRESHOLD)).otherwise(
        F.lit(200) * lcs > F.lit(SCORE_THRESHOLD) * total)
