"""Exact sums against math.fsum."""

import math
import random
import struct

from pyspark.sql import functions as F

from encore.functions import exact


def hostile(seed=1, groups=60):
    rnd = random.Random(seed)
    rows = []

    def any_double():
        while True:
            x = struct.unpack("d", rnd.randbytes(8))[0]
            if math.isfinite(x) and abs(x) < 1e300:
                return x

    for g in range(groups):
        kind = g % 6
        n = rnd.randint(1, 40)
        if kind == 0:
            xs = [any_double() for _ in range(n)]
        elif kind == 1:  # cancels to little
            xs = [rnd.uniform(-1, 1) * 10 ** rnd.randint(-12, 12) for _ in range(n)]
            xs += [-x for x in xs] + [2 ** -40, 5e-324]
        elif kind == 2:  # ties
            xs = [1.0, 2 ** -53, rnd.choice([0.0, 2 ** -106, -2 ** -106])] * rnd.randint(1, 3)
        elif kind == 3:
            xs = [0.1] * n
        elif kind == 4:
            xs = [2.0 ** rnd.randint(-60, 60) * rnd.choice([1, -1]) for _ in range(n)]
        else:
            xs = [5e-324 * rnd.randint(1, 9) for _ in range(n)] + [2.0 ** -1022, -0.0]
        rows += [(g, x) for x in xs]
    rnd.shuffle(rows)
    return rows


def test_equals_fsum_in_any_order(spark):
    rows = hostile()
    want = {}
    for g, x in rows:
        want.setdefault(g, []).append(x)
    want = {g: math.fsum(xs) for g, xs in want.items()}
    for parts in (1, 6):
        df = spark.createDataFrame(rows, "g int, x double").repartition(parts)
        got = {r.g: r.s for r in exact.exact_sums(df, ["g"], "x", "s").collect()}
        assert got == want


def test_ordinary_ratings(spark):
    rnd = random.Random(3)
    rows = [(i % 50, rnd.choice([0.03, 1234.56, 99999.99, 7.0]) * rnd.choice([3, 5, 10])) for i in range(4000)]
    got = {r.g: (r.s, r.n) for r in exact.exact_sums(
        spark.createDataFrame(rows, "g int, x double"), ["g"], "x", "s", F.count("*").alias("n")).collect()}
    for g in range(50):
        assert got[g] == (math.fsum(x for h, x in rows if h == g), 80)


def test_nulls_and_what_is_not_finite(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, None), (2, None), (2, 1.5), (3, inf), (3, 1.0), (4, inf), (4, -inf), (5, nan), (6, 0.0), (7, -3.0)]
    got = {r.g: r.s for r in exact.exact_sums(spark.createDataFrame(rows, "g int, x double"), ["g"], "x", "s").collect()}
    assert got[1] is None and got[2] == 1.5 and got[3] == inf and math.isnan(got[4]) and math.isnan(got[5])
    assert got[6] == 0.0 and got[7] == -3.0
    empty = spark.createDataFrame([], "g int, x double")
    assert exact.exact_sums(empty, ["g"], "x", "s").count() == 0


def test_parts_add_up(spark):
    df = spark.createDataFrame([(1, 0.1), (1, 1e16), (2, 0.3)], "g int, x double")
    more = spark.createDataFrame([(1, -1e16), (3, 2.0)], "g int, x double")
    grid = exact.grid_of(df.unionAll(more), "x")
    one, two = (exact.split(d, "x").groupBy("g").agg(exact.place_sums(grid).alias(n)) for d, n in ((df, "a"), (more, "b")))
    both = one.join(two, "g", "full").select("g", exact.added(F.col("a"), F.col("b")).alias("t"))
    assert {r.g: r.s for r in exact.with_rounded(both, "t", grid, "s").collect()} == {1: 0.1, 2: 0.3, 3: 2.0}
