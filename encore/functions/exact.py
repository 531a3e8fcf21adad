"""Exact sums of DOUBLE columns, rounded once (order-independent superaccumulator).

A finite double is split into four 20-bit limbs on a fixed grid of powers of
2**20; limbs of one grid place are added as BIGINT by Spark's own partial
aggregation, so the sum is exact whatever the order, the partitioning or the
number of retries. One rounding to the nearest double (ties to even) ends it:
the result equals ``math.fsum``. Grid places used are those between the least and
the greatest magnitude (``grid_of``), at most 110 of them; a place holds 2**42 rows.

NULLs are left out and no value at all gives NULL; with an infinity or a NaN
the result is that of the plain sum.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMB = 20
_BASE = 1 << LIMB
#: Places above a limb sum that its carries can reach.
_CARRY_PLACES = 3


@dataclass(frozen=True)
class Grid:
    """Places ``low`` to ``high`` (inclusive) of powers of 2**LIMB."""

    low: int
    high: int

    @property
    def places(self) -> range:
        return range(self.low, self.high + 1)


def _finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def _top(x: Column) -> Column:
    """Grid place of the leading bit; one too high or low at a power of two does no harm."""
    return F.floor(F.log2(F.abs(x)) / LIMB).cast("int")


def grid_of(df: DataFrame, *columns: str) -> Grid:
    """The grid that holds all finite values of ``columns`` (one pass over them)."""
    tops = [F.when(_finite(F.col(c)) & (F.col(c) != 0), _top(F.col(c))) for c in columns]
    found = df.agg(F.min(F.array_min(F.array(*tops))), F.max(F.array_max(F.array(*tops)))).first()
    low, high = (0, 0) if found[0] is None else found
    return Grid(low - 3, high)


def decimal_grid(precision: int, scale: int) -> Grid:
    """The grid that holds any DECIMAL(precision, scale) as a double."""
    bits = math.log2(10)
    return Grid(math.floor(-scale * bits / LIMB) - 4, math.ceil((precision - scale) * bits / LIMB))


def _limbs(x: Column) -> tuple[Column, list[Column]]:
    """Grid place of a finite non-zero value and its four limbs from there down (all of its sign)."""
    top = _top(x)
    # Two exact halves of the scaling: neither leaves the range of normal doubles.
    down, rest = F.floor(top / 2).cast("int"), (top - F.floor(top / 2)).cast("int")
    left = x * F.pow(F.lit(2.0), -LIMB * down) * F.pow(F.lit(2.0), -LIMB * rest)
    limbs = []
    for _ in range(4):
        whole = left.cast("bigint")  # towards zero, exact below 2**53
        limbs.append(whole)
        left = (left - whole.cast("double")) * _BASE
    return top, limbs


def split(df: DataFrame, column: str, name: str = "_exact") -> DataFrame:
    """``df`` with ``name``: (top, limbs, other) of ``column``; ``other`` holds infinities and NaN."""
    x = F.col(column).cast("double")
    good = _finite(x) & (x != 0)
    top, limbs = _limbs(F.when(good, x))
    return df.withColumn(name, F.struct(
        top.alias("top"), F.array(*limbs).alias("limbs"), F.when(x.isNotNull() & ~_finite(x), x).alias("other"),
        x.isNotNull().alias("there")))


def place_sums(grid: Grid, name: str = "_exact") -> Column:
    """Aggregate: BIGINT sums of the limbs at each place of ``grid``, lowest first, and what else the sum needs."""
    e = F.col(name)
    sums = []
    for place in grid.places:
        at = e["top"] - place  # the limb of this place, 0 to 3
        sums.append(F.sum(F.when(at.between(0, 3), F.get(e["limbs"], at)).otherwise(0).cast("bigint")))
    return F.struct(F.array(*sums).alias("places"), F.sum(e["other"]).alias("other"), F.max(e["there"]).alias("there"))


def place_values(grid: Grid, name: str = "_exact") -> Column:
    """What ``place_sums`` gives for one row; NULL where there is no value."""
    e = F.col(name)
    limbs = [F.coalesce(F.get(e["limbs"], e["top"] - place), F.lit(0)).cast("bigint") for place in grid.places]
    return F.when(e["there"], F.struct(F.array(*limbs).alias("places"), e["other"].alias("other"), e["there"].alias("there")))


def added(one: Column, two: Column) -> Column:
    """The sum of two results of ``place_sums`` over one grid; either may be NULL."""
    return (F.when(one.isNull(), two).when(two.isNull(), one).otherwise(F.struct(
        F.zip_with(one["places"], two["places"], lambda x, y: x + y).alias("places"),
        F.coalesce(one["other"] + two["other"], one["other"], two["other"]).alias("other"),
        (one["there"] | two["there"]).alias("there"))))


def _carried(places: Column) -> Column:
    """(carry, digits): digits from 0 to 2**LIMB - 1, highest first; the carry is -1 for a negative sum, else 0."""
    start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("digits"))

    def step(acc, s):
        total = s + acc["carry"]
        return F.struct(F.shiftright(total, LIMB).alias("carry"),
                        F.concat(F.array(total.bitwiseAND(F.lit(_BASE - 1).cast("bigint"))), acc["digits"]).alias("digits"))

    return F.aggregate(F.concat(places, F.array_repeat(F.lit(0).cast("bigint"), _CARRY_PLACES)), start, step)


def with_rounded(df: DataFrame, sums: str, grid: Grid, name: str) -> DataFrame:
    """``df`` with column ``sums`` (of ``place_sums``) replaced by the nearest double, as ``name``."""
    kept = [c for c in df.columns if c != sums]
    first = _carried(F.col(sums)["places"])
    out = df.select("*", first.alias("_first"))
    flipped = _carried(F.transform(F.col(sums)["places"], lambda s: -s))
    out = out.withColumn("_negative", F.col("_first")["carry"] < 0)
    out = out.withColumn("_digits", F.when(F.col("_negative"), flipped["digits"]).otherwise(F.col("_first")["digits"]))
    out = out.withColumn("_at", F.array_position(F.transform("_digits", lambda d: d > 0), True).cast("int"))
    digit = [F.coalesce(F.get("_digits", F.col("_at") - 1 + k), F.lit(0).cast("bigint")) for k in range(4)]
    rest = F.exists(F.slice("_digits", F.col("_at") + 4, len(grid.places) + _CARRY_PLACES), lambda d: d > 0)
    out = out.select("*", *[d.alias(f"_d{k}") for k, d in enumerate(digit)], rest.alias("_rest"))
    a, b, c, d = (F.col(f"_d{k}") for k in range(4))
    lost = F.col("_rest").cast("bigint")

    def word(up: int) -> Column:
        """At least 55 leading bits, the last one set if anything below is: rounds as the whole sum does."""
        low = up - 60  # shift of the fourth digit
        head = F.shiftleft(a, up).bitwiseOR(F.shiftleft(b, up - 20)).bitwiseOR(F.shiftleft(c, up - 40))
        cut = (d.bitwiseAND(F.lit((1 << -low) - 1).cast("bigint")) != 0).cast("bigint")
        return head.bitwiseOR(F.shiftright(d, -low)).bitwiseOR(cut).bitwiseOR(lost)

    shift = F.when(a >= 1 << 14, 40).when(a >= 1 << 6, 48).otherwise(56)
    value = F.when(a >= 1 << 14, word(40)).when(a >= 1 << 6, word(48)).otherwise(word(56)).cast("double")
    # The first digit is worth 2**(LIMB * place); places count down from the highest.
    up = (F.lit(LIMB * (grid.high + _CARRY_PLACES)) - LIMB * (F.col("_at") - 1) - shift).cast("int")
    half = F.floor(up / 2).cast("int")
    value = value * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), up - half)
    total = F.col(sums)
    result = (F.when(total.isNull() | ~F.coalesce(total["there"], F.lit(False)), F.lit(None).cast("double"))
              .when(total["other"].isNotNull(), total["other"])
              .when(F.col("_at") == 0, F.lit(0.0))
              .when(F.col("_negative"), -value).otherwise(value))
    return out.select(*[F.col(f"`{c}`") for c in kept], result.alias(name))


def exact_sums(df: DataFrame, keys: list[str], column: str, name: str, *others: Column) -> DataFrame:
    """``keys``, ``others`` and the exact sum of ``column`` for each group, as ``name``: one shuffle."""
    grid = grid_of(df.select(F.col(column).cast("double").alias(column)), column)
    found = split(df, column).groupBy(*keys).agg(*others, place_sums(grid).alias("_sum"))
    return with_rounded(found, "_sum", grid, name)
