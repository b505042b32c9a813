"""Decimal text against Python's own formatting."""

import math
import random
import struct

from rollscore.functions import decimals as D


def doubles():
    rnd = random.Random(9)
    out = [0.0, -0.0, 0.5, -0.5, 0.0005, 0.0015, 0.0025, 0.0625, 0.1875, 1e-05, -1e-05, 1.0, 36.0, 1e15, 1e16, 1e22, 123456789012345680.0,
           9007199254740993.0, 2.0**62, 2.0**63, 2.0**70 + 2.0**20, 1e30, -1e30, 2.0**119, 5e-324, 1.7976931348623157e308, 2.2250738585072014e-308,
           0.9995, 0.99949999999999994, 0.9999, 999.9995, 1e-4, 9.999e-5, 0.1 + 0.2, 2e23, 1e23, 2.0e-3, 9.5e-323, 2.2e-322, 1.1e-5,
           math.nan, math.inf, -math.inf, 4503599627370495.5, 4503599627370497.5, 0.05, 0.25, 0.35, 2.675, 1.005]
    for _ in range(3000):
        x = struct.unpack("<d", struct.pack("<Q", rnd.getrandbits(64)))[0]
        out.append(x)
    for _ in range(3000):
        out.append(rnd.uniform(-100, 100))
        out.append(rnd.randint(-10**6, 10**6) / 2 ** rnd.randint(0, 12))  # exact ties
        out.append(round(rnd.uniform(-10, 10), rnd.randint(0, 6)))
        out.append(rnd.uniform(-1, 1) * 10 ** rnd.randint(-20, 20))
    return out


def test_fixed_and_shortest(spark):
    xs = doubles()
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i long, x double").repartition(8)
    got = df.select("i", D.fixed("x", 3).alias("f3"), D.fixed("x", 4).alias("f4"), D.fixed("x", 1).alias("f1"),
                    D.fixed("x", 15).alias("f15"), D.shortest("x").alias("r")).collect()
    assert len(got) == len(xs)
    for row in got:
        x = xs[row.i]
        if 1e-27 <= abs(x) < 1e38 or x == 0 or not math.isfinite(x):
            assert row.r == repr(x), (x, row.r)
        else:
            assert float(row.r) == x and len(row.r) <= len(repr(x)) + 1, (x, row.r)
        if abs(x) < 2.0**120 or not math.isfinite(x):
            assert (row.f1, row.f3, row.f4, row.f15) == ("%.1f" % x, "%.3f" % x, "%.4f" % x, "%.15f" % x), (x, row)


def test_null(spark):
    row = spark.sql("SELECT CAST(NULL AS DOUBLE) AS x").select(D.fixed("x", 3).alias("a"), D.shortest("x").alias("b")).first()
    assert row.a is None and row.b is None


def test_the_smallest_doubles(spark):
    xs = [k * 5e-324 for k in range(1, 40)]
    df = spark.createDataFrame([(x * s,) for x in xs for s in (1, -1)], "x double")
    assert [r.r for r in df.select(D.shortest("x").alias("r")).collect()][:6] == ["5e-324", "-5e-324", "1e-323", "-1e-323", "1.5e-323", "-1.5e-323"]
