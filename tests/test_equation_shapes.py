"""F2-F4 over whole columns: values by shape as text by text, and the numbers of tasks cast once."""

import math
import random
import warnings

import pyarrow as pa
from pyspark.sql import functions as F

from rollscore.functions import equation as Q
from rollscore.functions import numbers as N


def _python(text):
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            return float(eval(text, {"__builtins__": None}, {}))
    except Exception:
        return None


def _same(a, b):
    if a is None or b is None:
        return a is b
    return (a == b and math.copysign(1, a) == math.copysign(1, b)) or (a != a and b != b)


def test_a_column_has_the_values_of_its_texts():
    rng = random.Random(11)
    parts = ["0", "1", "7", "00", "012", "45", str(10**30), "1" + "0" * 140, "+", " - ", " * ", " / ", "//", "(", ")", " ", "\t", "\n"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(8))) for _ in range(6000)]
    texts += [f"{rng.randrange(99)} / {rng.randrange(3)} - {rng.randrange(9)}" for _ in range(3000)]
    texts += ["0/-1", "-0", "1(2)", "()", "5\n", "(" * 60 + "1" + ")" * 60, "(" * 250 + "1" + ")" * 250, None, "2.5", ""]
    rng.shuffle(texts)
    got = Q._evaluate_arrow(pa.array(texts, pa.string())).to_pylist()
    for text, value in zip(texts, got):
        want = _python(text) if text is not None and Q._PY_GUARD.fullmatch(text) else None
        assert _same(value, want), (text, value, want)
    assert Q._evaluate_arrow(pa.array([], pa.string())).to_pylist() == []


def test_a_shape_is_parsed_once(monkeypatch):
    parsed = []
    monkeypatch.setattr(Q, "_shapes", Q._Shapes())
    monkeypatch.setattr(Q, "_steps", lambda shape, plain=Q._steps: parsed.append(shape) or plain(shape))
    texts = [f"{i} + {i * 7} - ({i % 13})" for i in range(20_000)] + [f"{i} +" for i in range(5000)]
    got = Q._evaluate_arrow(pa.array(texts)).to_pylist()
    assert got == [float(i * 8 - i % 13) for i in range(20_000)] + [None] * 5000
    assert sorted(parsed) == ["1 +", "1 + 1 - (1)"]


def test_numbers_of_a_row(spark):
    rows = [(1, "12 + 7 - 12", [7, 12, 12], [7, 12, 12], True, 3), (2, "99999999999999999999 + 1", [1, 2], [None, 1], False, 1),
            (3, None, [1], None, False, 0), (4, "1", None, [1], False, 0), (5, "no", [], [], True, 0), (6, "3 + 4", [3, None], [3, 4], False, 1)]
    df = spark.createDataFrame([r[:3] for r in rows], "i int, equation string, nums array<int>").withColumn("f", N.found_numbers("equation"))
    got = df.select("i", F.sort_array("f").alias("f"), N.numbers_match("f", "nums").alias("ok"), N.matched_count("f", "nums").alias("n")).collect()
    assert [(r.i, r.f, r.ok, r.n) for r in sorted(got)] == [(i, f if f is None else sorted(f, key=lambda x: (x is not None, x)), ok, n)
                                                           for i, _, _, f, ok, n in rows]
