"""Golden values for answer parsing, equation values and the reward grid."""

import math

import pytest
from pyspark.sql import functions as F

from rollscore.functions import numbers as N
from rollscore.functions import text as X
from rollscore.functions.equation import evaluate_equation, evaluate_equation_py
from rollscore.operators.scoring import score_all

NUMS = [79, 17, 60]

# (case, target, response, R0 sparse, R1 hybrid, R2 graded, R3 format, R4 reason, R5 signed5, R6 signed10)
GRID = [
    ("no tag", 36, "79 - 60 + 17 = 36", 0, 0, 0, 0, 0, -0.1, -0.1),
    ("exact, no think", 36, "<answer>(79 - (60 - 17))</answer>", 1, 1, 1, 0.61, 1, 1, 1),
    ("exact, think", 36, "<think>a b</think> <answer>79 - 60 + 17</answer>", 1, 1, 1, 0.614, 1, 1, 1),
    ("two tags", 36, "<answer>1</answer> <ANSWER> 79-60+17 </ANSWER>", 1, 1, 1, 0.608, 1, 1, 1),
    ("wrong numbers", 36, "<answer>79 - 60</answer>", 0.1, 0.1, 0.266667, 0.806, 0.3, -0.05, -0.05),
    ("repeated number", 36, "<answer>79 - 17 - 17</answer>", 0.1, 0.1, 0.3, 1, 0.3, -0.05, -0.05),
    ("trailing = 36", 36, "<answer>79 - 60 + 17 = 36</answer>", 0.1, 0.1, 0.3, 1, 0.3, -0.05, -0.05),
    ("syntax error", 36, "<answer>79 - 60 + 17 +</answer>", 0.1, 0.2, 0.4, 0.562, 0.5, 0.15, 0.15),
    ("off by 1", 35, "<answer>79 - 60 + 17</answer>", 0.1, 0.92, 0.6, 0.56, 0.5, 0.4, 0.4),
    ("off by 4", 40, "<answer>79 - 60 + 17</answer>", 0.1, 0.68, 0.66, 0.56, 0.58, 0.46, 0.58),
    ("off by 8", 28, "<answer>79 - 60 + 17</answer>", 0.1, 0.419525, 0.64, 0.56, 0.56, 0.42019, 0.46),
    ("off by 20", 56, "<answer>79 - 60 + 17</answer>", 0.1, 0.219915, 0.613534, 0.56, 0.54, 0.401832, 0.413534),
    ("off by 60", 96, "<answer>79 - 60 + 17</answer>", 0.1, 0.200007, 0.600248, 0.56, 0.509072, 0.400674, 0.400674),
    ("empty tag", 36, "<answer></answer>", 0.1, 0.1, 0.2, 0.302, 0.3, -0.05, -0.05),
    ("repeated spam", 36, "<answer>79 79 79 60 60 17</answer>", 0.1, 0.1, 0.4, 1, 0.3, -0.05, -0.05),
]
RULES = [("sparse", None), ("hybrid", 5.0), ("graded", 5.0), ("format", None), ("reason", 5.0),
         ("signed5", 5.0), ("signed10", 10.0)]


def test_reward_grid(spark):
    rows = [(i, g[1], NUMS, g[2]) for i, g in enumerate(GRID)]
    df = spark.createDataFrame(rows, "i int, target int, nums array<int>, response string")
    out = score_all(df, {r: (r, s) for r, s in RULES}).orderBy("i").collect()
    for g, row in zip(GRID, out):
        for j, (rule, _) in enumerate(RULES):
            assert row[rule] == pytest.approx(g[3 + j], abs=1e-6), (g[0], rule, row[rule])


def test_graded_above_one_with_think(spark):
    # R2 is not capped: think bonus + small distance exceeds 1 (kept as in the reference).
    cases = [(0.001, 1.1996), (0.25, 1.1), (0.5, 1.0), (1.0, 0.8), (1.01, 1.0394)]
    rows = [(i, 36, NUMS, f"<think>x</think><answer>79 - 60 + 17 + {d}</answer>") for i, (d, _) in enumerate(cases)]
    # the answer with a decimal point is not evaluable, so feed results directly
    df = spark.createDataFrame([(i, 36.0 + d, True, True) for i, (d, _) in enumerate(cases)],
                               "i int, result double, ok boolean, think boolean")
    from rollscore.functions.rewards import AnswerColumns, graded
    a = AnswerColumns(F.lit("x"), F.col("ok"), F.col("result"), F.abs(F.col("result") - 36.0), F.col("think"),
                      F.lit(3), F.lit(3), F.lit(5))
    got = [r[0] for r in df.orderBy("i").select(graded(a)).collect()]
    for (d, want), g in zip(cases, got):
        assert g == pytest.approx(want, abs=1e-4), d
    assert rows  # the text rows document the intent


EXTRACT = [
    ("Okay, let's see. I need to use 79, 17, ... So the equation is ,→ <answer>(79 - (60 - 17))</answer>", "(79 - (60 - 17))"),
    ("So the equation is <answer> 79 - (60 - 17)</answer>", "79 - (60 - 17)"),
    ("x <answer>  1+2 \u001c</answer>", "1+2"),
    ("<ANſWER>3</ANSWER>", "3"),
    ("<answer>a</answer>b<answer>c\nd</answer>", "c\nd"),
    ("<answer> <answer>1</answer>", "<answer>1"),
    ("<answer></answer>", ""),
    ("no tag here", None),
    ("", None),
    (None, None),
]


def test_extract_answer(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(EXTRACT)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(X.extract_answer("t")).collect()]
    assert got == [e for _, e in EXTRACT]


def test_validate_numbers(spark):
    cases = [("(79 - (60 - 17))", [79, 60, 17], True), ("(79 - 60)", [79, 60, 17], False),
             ("(79 - 17 - 17)", [79, 60, 17], False), ("79 + 60 + 17", [79, 17, 60], True),
             ("", [1, 2, 3], False), ("-79 + 60 + 17", [79, 60, 17], True), ("7.9", [7, 9], True),
             ("٧٩ + 60 + 17", [79, 60, 17], True), ("0079 + 60 + 17", [79, 60, 17], True),
             ("99999999999999999999999 + 1", [1, 2], False)]
    df = spark.createDataFrame([(i, e, n) for i, (e, n, _) in enumerate(cases)], "i int, e string, n array<int>")
    got = [r[0] for r in df.orderBy("i").select(N.validate_numbers("e", "n")).collect()]
    assert got == [c[2] for c in cases]


EQUATIONS = [
    ("2**3", 8.0), ("7//2", 3.0), ("-7//2", -4.0), ("2**3**2", 512.0), ("-2**2", -4.0), ("2**-1", 0.5),
    ("--5", 5.0), ("+-+3", -3.0), ("007", None), ("5-", None), ("1 2", None), ("()", None), ("2(3)", None),
    ("(1)(2)", None), ("1/0", None), ("(-8)**(1/3)", None), ("9**999", None), ("1\n+2", None), ("", None),
    ("1=1", None), ("1%2", None), ("1,2", None), ("1.5", None), ("a", None), ("00", 0.0), ("(1\n+2)", 3.0),
    ("  1 + 2  ", 3.0), ("(10**308/1)*10", math.inf), ("9007199254740993-9007199254740992", 1.0),
    ("9**9**9**9", None), ("79 - (60 - 17)", 36.0), ("79 / 17 + 60", 79 / 17 + 60),
]


@pytest.mark.parametrize("text,want", EQUATIONS)
def test_evaluate_equation_py(text, want):
    assert evaluate_equation_py(text) == want


def test_evaluate_equation_spark(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(EQUATIONS)] + [(len(EQUATIONS), None)],
                               "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(evaluate_equation("t")).collect()]
    assert got == [w for _, w in EQUATIONS] + [None]


def test_nan_result_is_not_null(spark):
    df = spark.createDataFrame([("(10**308/1)*10-(10**308/1)*10",)], "t string")
    v = df.select(evaluate_equation("t")).first()[0]
    assert v is not None and math.isnan(v)


def test_word_count_unicode(spark):
    df = spark.createDataFrame([("a\u001cb c",), ("  two  words ",), ("",)], "t string")
    assert [r[0] for r in df.select(X.word_count("t")).collect()] == [3, 2, 0]


def test_stop_truncate_and_strip(spark):
    df = spark.createDataFrame([("a</answer>b</answer>", "  x y\u001c\n")], "r string, s string")
    row = df.select(X.truncate_at_stop("r"), X.py_strip("s")).first()
    assert row[0] == "a</answer>" and row[1] == "x y"


def test_whitespace_class_matches_python(spark):
    import sys
    ws = [c for c in range(sys.maxunicode + 1) if chr(c).isspace()]
    others = [0x41, 0x30, 0x5f, 0x1b, 0x20 + 1, 0x180e, 0x200b, 0xfeff, 0x2060, 0x1f600]
    rows = [(c, f"a{chr(c)}b") for c in ws + others]
    df = spark.createDataFrame(rows, "c int, t string")
    got = {r[0]: r[1] for r in df.select("c", X.word_count("t")).collect()}
    for c in ws:
        assert got[c] == 2, hex(c)
    for c in others:
        assert got[c] == 1, hex(c)
