"""Decimal text of doubles as Python prints it, from the value of the double itself.

``fixed`` is Python's ``'%.<digits>f' % x``: the binary value, correctly rounded, ties to even. The fraction is split
off exactly and scaled by a power of ten as an error-free product (a double and its rounding error), which decides
every rounding; from 2**120 on the digits after the shortest ones are zeros. ``shortest`` is ``repr(x)``: the fewest
digits that read back as the same double, the nearest such decimal (for 1e-27 <= |x| < 1e38; beyond, the digits of
the JVM, which read back but may be one longer or not the nearest). Both are DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# Fixed values of Dekker's splitting of a double into two halves of 26 bits.
SPLITTER = 134217729.0
TWO_60 = float(1 << 60)
MAX_DIGITS = 15


def _split(a: float) -> tuple[float, float]:
    c = SPLITTER * a
    high = c - (c - a)
    return high, a - high


def _sign(x: Column) -> Column:
    return F.when(x.cast("string").startswith("-"), "-").otherwise("")


def _special(x: Column, text: Column) -> Column:
    return (F.when(F.isnan(x), "nan").when(x == float("inf"), "inf").when(x == float("-inf"), "-inf").otherwise(text))


def _whole_text(whole: Column) -> Column:
    """Digits of a nonnegative whole double: 64-bit below 2**63, else two parts of a 38-digit decimal (below 2**123);
    above that the shortest digits filled up with zeros."""
    high = F.floor(whole / F.lit(TWO_60))
    low = (whole - high.cast("double") * F.lit(TWO_60)).cast("bigint")
    wide = high.cast("decimal(19,0)") * F.lit(1 << 60).cast("decimal(19,0)") + low.cast("decimal(19,0)")
    small = whole.cast("bigint").cast("string")
    return (F.when(whole < F.lit(float(1 << 62)), small)
            .when(whole < F.lit(2.0**120), wide.cast("decimal(38,0)").cast("string"))
            .otherwise(F.format_string("%.0f", whole)))


def fixed(x, digits: int) -> Column:
    """``'%.<digits>f' % x`` for 1 to 15 digits; NULL stays NULL."""
    if not 1 <= digits <= MAX_DIGITS:
        raise ValueError(f"digits must be 1 to {MAX_DIGITS}")
    return _let(as_col(x).cast("double"), lambda v: F.when(v.isNotNull(), _special(v, _fixed(v, digits))))


def _fixed(x: Column, digits: int) -> Column:
    def text(size: Column, whole: Column) -> Column:
        part = _let(_product(size - whole, F.lit(digits)), lambda y: _round(y["p"], y["e"]))
        return _let(part, lambda n: _let(n == 10**digits, lambda carry: F.concat(
            _whole_text(whole + F.when(carry, 1.0).otherwise(0.0)), F.lit("."),
            F.lpad(F.when(carry, F.lit(0)).otherwise(n).cast("string"), digits, "0"))))

    whole = lambda size: F.when(size < F.lit(2.0**53), F.floor(size).cast("double")).otherwise(size)
    return F.concat(_sign(x), _let(F.abs(x), lambda size: _let(whole(size), lambda w: text(size, w))))


def _digits(x: Column) -> Column:
    """(d, e): x = 0.d * 10**e for a nonnegative x, from the text of the JVM."""
    text = x.cast("string")
    mantissa = F.substring_index(text, "E", 1)
    power = F.when(F.contains(text, F.lit("E")), F.substring_index(text, "E", -1).cast("int")).otherwise(0)
    point = F.locate(".", mantissa) - 1
    joined = F.regexp_replace(mantissa, r"\.", "")
    kept = F.regexp_replace(joined, "^0+", "")
    lead = F.length(joined) - F.length(kept)
    return F.struct(F.regexp_replace(kept, "0+$", "").alias("d"), (point + power - lead).cast("int").alias("e"))


def _read(d: Column, e: Column) -> Column:
    return F.concat(F.lit("0."), d, F.lit("E"), e.cast("string")).cast("double")


def _table(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


POWERS = [10.0**i for i in range(23)]  # the powers of ten that a double holds exactly


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _product(a: Column, place: Column) -> Column:
    """(p, e): a * 10**place and its rounding error, 0 <= place <= 22."""
    power = F.element_at(_table(POWERS), place + 1).alias("power")
    high = F.element_at(_table(_split(p)[0] for p in POWERS), place + 1).alias("high")
    low = F.element_at(_table(_split(p)[1] for p in POWERS), place + 1).alias("low")

    def error(t: Column, v: Column) -> Column:
        top = v["cut"] - (v["cut"] - t["a"])
        return _let(F.struct(top.alias("top"), (t["a"] - top).alias("rest")), lambda w: F.struct(
            v["p"].alias("p"),
            (((w["top"] * t["high"] - v["p"]) + w["top"] * t["low"] + w["rest"] * t["high"]) + w["rest"] * t["low"]).alias("e")))

    return _let(F.struct(a.alias("a"), power, high, low), lambda t: _let(
        F.struct((t["a"] * t["power"]).alias("p"), (t["a"] * F.lit(SPLITTER)).alias("cut")), lambda v: error(t, v)))


def _scaled(x: Column, s: Column) -> Column:
    """(p, e) with x * 10**s = p + e, exact for 0 <= s <= 22, else to about 30 digits."""
    many = F.least(F.greatest(s - 22, F.lit(0)), F.lit(22))
    up = _let(_product(x, F.least(F.greatest(s, F.lit(0)), F.lit(22))), lambda one: _let(
        _product(one["p"], many), lambda two: _let(
            two["e"] + one["e"] * F.element_at(_table(POWERS), many + 1), lambda e: _let(two["p"] + e, lambda p: F.struct(
                p.alias("p"), (e - (p - two["p"])).alias("e"))))))
    less = F.least(F.greatest(-s, F.lit(0)), F.lit(22))
    power = F.element_at(_table(POWERS), less + 1)
    down = _let(x / power, lambda q: _let(_product(q, less), lambda back: F.struct(
        q.alias("p"), (((x - back["p"]) - back["e"]) / power).alias("e"))))
    return F.when(s >= 0, up).otherwise(down)


def _round(value: Column, error: Column) -> Column:
    """value + error to the nearest integer, ties to even; value is nonnegative and error at most half its last place."""

    def small(below: Column) -> Column:
        half = (value - below.cast("double")) - F.lit(0.5)
        return below + F.when((half > 0) | ((half == 0) & ((error > 0) | ((error == 0) & (below % 2 == 1)))), 1).otherwise(0)

    return _let(F.floor(value), lambda below: F.when(value < F.lit(2.0**53), small(below)).otherwise(
        below + F.rint(error).cast("bigint")))


def _nearest(x: Column, s: Column) -> Column:
    """x * 10**s, rounded to the nearest integer (below 10**18), for -22 <= s <= 44; NULL elsewhere."""
    inside = (s >= -22) & (s <= 44) & (x < F.lit(1e290)) & (x > F.lit(1e-290))
    return F.when(inside, _let(_scaled(x, s), lambda y: _round(y["p"], y["e"])))


def _shorter(x: Column, found: Column) -> Column:
    """The JVM may print more digits than needed, or not the nearest ones: take the nearest decimal of as few digits as
    read back (tried from the JVM's number of digits downwards)."""
    size, exponent = F.length(found["d"]), found["e"]

    def choose(state: Column, digits: Column, near: Column) -> Column:
        e = F.when(F.length(near) > digits, exponent + 1).otherwise(exponent)
        fits = (digits >= 1) & near.isNotNull() & (_read(near, e) == x)
        return F.when(F.coalesce(fits, F.lit(False)), F.struct(near.alias("d"), e.alias("e"))).otherwise(state)

    def one(state: Column, drop: Column) -> Column:
        digits = size - drop
        return _let(_nearest(x, digits - exponent).cast("string"), lambda near: choose(state, digits, near))

    return F.aggregate(F.array(F.lit(0), F.lit(1), F.lit(2)), found, one)


def shortest(x) -> Column:
    """``repr(x)`` of Python: the shortest digits, exponents from 1e16 and below 1e-4."""
    return _let(as_col(x).cast("double"), lambda v: F.when(v.isNotNull(), _special(v, F.concat(_sign(v), _let(
        F.abs(v), lambda size: _let(_digits(size), lambda found: _let(
            _shorter(size, found), lambda state: _let(
                F.struct(F.regexp_replace(state["d"], "0+$", "").alias("d"), state["e"].alias("e")),
                lambda best: _layout(size, _tiny(size, "5", "1", best["d"]), _tiny(size, -323, -322, best["e"]))))))))))


def _tiny(size: Column, least, second, other: Column) -> Column:
    """The two smallest doubles: one digit names them, where the JVM prints two."""
    return F.when(size == F.lit(5e-324), F.lit(least)).when(size == F.lit(1e-323), F.lit(second)).otherwise(other)


def _layout(x: Column, d: Column, e: Column) -> Column:
    """Python's layout of the digits."""
    n = F.length(d)
    plain = (
        F.when(e <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -e), d))
        .when(n <= e, F.concat(F.rpad(d, e, F.lit("0")), F.lit(".0")))
        .otherwise(F.concat(F.substring(d, F.lit(1), e), F.lit("."), F.substring(d, e + 1, n))))
    power = e - 1
    sign = F.when(power < 0, "-").otherwise("+")
    rest = F.when(n > 1, F.concat(F.lit("."), F.substring(d, F.lit(2), n))).otherwise("")
    exponent = F.abs(power).cast("string")
    science = F.concat(F.substring(d, 1, 1), rest, F.lit("e"), sign,
                       F.when(F.length(exponent) < 2, F.lpad(exponent, 2, "0")).otherwise(exponent))
    return F.when(x == 0, "0.0").when((e > -4) & (e <= 16), plain).otherwise(science)
