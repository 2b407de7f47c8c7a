"""Exact arithmetic for values that are compared or thresholded.

Money is carried as integer units (1e-5 dollar for order totals) and summed
as integers, so a sum is the same bits whatever the partitioning or engine.
Percentages that the reference rounds to 2 decimals are ratios of integer
counts; they are rounded half-up on the exact rational with integer division.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY_SCALE = 100000          # units per dollar for order totals
RATE_SCALE = 10 ** 9          # units per dollar for per-month velocities


BIG = "decimal(38,0)"


def idiv(a: Column, b: Column) -> Column:
    """Integer quotient (SQL ``a div b``) of two BIGINTs, whose quotient is one."""
    return F.call_function("div", a, b)


def big_div(a: Column, b: Column) -> Column:
    """Integer quotient of two whole decimals, as a decimal. SQL's ``div`` gives a
    BIGINT for decimals too and wraps beyond it without an error; here a quotient of
    more than 32 digits ends the query."""
    a, b = a.cast(BIG), b.cast(BIG)
    return ((a - a % b) / b).cast(BIG)


def half_up_div(num: Column, den: Column) -> Column:
    """round(num / den) half-up for BIGINTs num >= 0, den > 0, exactly: no doubled
    dividend, which could pass 64 bits where num does not."""
    whole, rest = idiv(num, den), num % den
    return whole + F.when(rest >= den - rest, 1).otherwise(0)


def big_half_up_div(num: Column, den: Column) -> Column:
    """``half_up_div`` of whole decimals."""
    return big_div(num * 2 + den, den * 2)


def money_to_units(money: Column) -> Column:
    return F.round(money * F.lit(MONEY_SCALE)).cast("long")


def cents_of(units: Column) -> Column:
    """An exact sum of money units, half-up to whole cents, as dollars."""
    return half_up_div(units, F.lit(MONEY_SCALE // 100)).cast("double") / F.lit(100.0)


def mean_to(units: Column, count: Column, scale: int, digits: int) -> Column:
    """The mean of integer units (``scale`` of them are 1), half-up to ``digits``
    decimals, from exact sums; NULL over no rows. A mean of BIGINTs is one, so the
    quotient is too, for means below 9e18 * scale / 10^digits."""
    num = (units.cast("decimal(38,0)") * (10 ** digits)).cast("decimal(38,0)")
    den = (count.cast("decimal(38,0)") * scale).cast("decimal(38,0)")
    return F.when(den > 0, idiv(num * 2 + den, den * 2).cast("double") / F.lit(float(10 ** digits)))


def pct2(num: Column, den: Column) -> Column:
    """round(100 * num / den, 2) on the exact ratio of two counts; NULL if den
    is 0 or NULL. A share is at most 1, so the quotient is a BIGINT."""
    n = num.cast("decimal(38,0)")
    d = den.cast("decimal(38,0)")
    return F.when(d > 0, idiv(n * 20000 + d, d * 2).cast("double") / F.lit(100.0))


def ratio2(num: Column, den: Column) -> Column:
    """round(num / den, 2) on the exact ratio of two integers, of any size."""
    n = num.cast("decimal(38,0)")
    d = den.cast("decimal(38,0)")
    return F.when(d > 0, big_half_up_div(n * 100, d).cast("double") / F.lit(100.0))


LIMB = 10 ** 9


def moments(x: str) -> list[Column]:
    """Mergeable exact moments of the BIGINT column ``x``: its sum and, with
    x = high * LIMB + low, the three sums whose combination is the sum of squares.
    Each stays below 38 digits for 10^18 rows of any BIGINTs; null counts as no row."""
    v = F.col(x)
    high, low = idiv(v, F.lit(LIMB)).cast("decimal(19,0)"), (v % LIMB).cast("decimal(19,0)")
    parts = {"n": F.count(v).cast(BIG), "sum": F.sum(v.cast(BIG)), "hh": F.sum((high * high).cast("decimal(28,0)")),
             "hl": F.sum((high * low).cast("decimal(28,0)")), "ll": F.sum((low * low).cast("decimal(28,0)"))}
    return [c.cast(BIG).alias(f"{x}_{k}") for k, c in parts.items()]


def with_sample_std(sums: DataFrame, *xs: str) -> DataFrame:
    """``sums`` (the aggregates ``moments``) with ``<x>_std``, the sample standard
    deviation of each x; null for fewer than two rows.

    With c the whole part of the mean and r the rest of its division, the squares
    about c sum to sum(x^2) - c * (sum(x) + r). That is exact in limbs, whose carries
    leave no negative one, so the double at the end loses nothing to cancellation.
    The steps are columns of their own: each is computed once."""
    limb = F.lit(LIMB).cast(BIG)
    big = lambda e: e.cast(BIG)
    steps: list[dict] = [
        {"c": lambda x: big_div(x("sum"), x("n"))},
        {"r": lambda x: big(x("sum") - big(x("c") * x("n")))},
        {"s": lambda x: big(x("sum") + x("r"))},
        {"c1": lambda x: big_div(x("c"), limb), "s1": lambda x: big_div(x("s"), limb)},
        {"c0": lambda x: big(x("c") - big(x("c1") * limb)), "s0": lambda x: big(x("s") - big(x("s1") * limb))},
        {"d0": lambda x: big(x("ll") - big(x("c0") * x("s0"))), "d2": lambda x: big(x("hh") - big(x("c1") * x("s1"))),
         "d1": lambda x: big(big(x("hl") * 2) - big(big(x("c1") * x("s0")) + big(x("c0") * x("s1"))))},
        {"low": lambda x: F.pmod(x("d0"), limb)},
        {"d1": lambda x: big(x("d1") + big_div(big(x("d0") - x("low")), limb))},
        {"mid": lambda x: F.pmod(x("d1"), limb)},
        {"d2": lambda x: big(x("d2") + big_div(big(x("d1") - x("mid")), limb))},
    ]
    out = sums
    for step in steps:
        out = out.withColumns({f"_{x}_{k}": e(_named(out, x)) for x in xs for k, e in step.items()})
    base = F.lit(float(LIMB))
    found = {}
    for x in xs:
        of = _named(out, x)
        n, r = of("n").cast("double"), of("r").cast("double")
        about_c = (of("d2").cast("double") * base + of("mid").cast("double")) * base + of("low").cast("double")
        found[f"{x}_std"] = F.when(n > 1, F.sqrt(F.greatest(about_c - r * r / n, F.lit(0.0)) / (n - 1)))
    return out.select(*[F.col(f"`{c}`") for c in sums.columns], *[e.alias(n) for n, e in found.items()])


def _named(df: DataFrame, x: str):
    """Columns of the moments of x, or of a step made from them."""
    return lambda k: F.col(f"_{x}_{k}" if f"_{x}_{k}" in df.columns else f"{x}_{k}")


def round_to(x: Column, digits: int) -> Column:
    """Presentation rounding of a double: round(x * 10^d) / 10^d. Half-way
    cases of the scaled double round the same way in every engine, unlike
    round(x, d), whose decimal half-way points are not representable."""
    s = float(10 ** digits)
    # "+ 0.0" turns a negative zero into 0.0 so equal values print equally
    return F.round(x * F.lit(s)) / F.lit(s) + F.lit(0.0)
