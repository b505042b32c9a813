"""Reward registry (R0-R6, U1): every rule is a ``when`` chain over staged
answer columns, so scoring stays inside whole-stage codegen.

Inputs are the columns added by :func:`rollscore.operators.scoring.stage_answers`:

=============  ==========================================================
``equation``   F1, NULL when there is no answer tag
``numbers_ok`` F2
``result``     F3, NULL when not evaluable
``distance``   F8, ``abs(result - target)``
``has_think``  F5
``n_matched``  F4
``n_nums``     ``size(nums)``
``n_words``    F6
=============  ==========================================================

Additions follow the reference's order so the doubles come out identical
(``0.4 + 0.2`` is ``0.6000000000000001``), and comparisons keep Python's NaN
behaviour.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import py_le, py_lt, py_max, py_min

EXACT_TOL = 1e-6


@dataclass(frozen=True)
class AnswerColumns:
    equation: Column
    numbers_ok: Column
    result: Column
    distance: Column
    has_think: Column
    n_matched: Column
    n_nums: Column
    n_words: Column

    @staticmethod
    def staged(prefix: str = "") -> "AnswerColumns":
        c = lambda name: F.col(prefix + name)
        return AnswerColumns(
            c("equation"), c("numbers_ok"), c("result"), c("distance"),
            c("has_think"), c("n_matched"), c("n_nums"), c("n_words"),
        )


def _l(x: float) -> Column:
    return F.lit(float(x))


def _max0(x: Column) -> Column:
    """Python ``max(0.0, x)``."""
    return py_max(_l(0.0), x)


def _exact(a: AnswerColumns) -> Column:
    return py_lt(a.distance, _l(EXACT_TOL))


def _share(a: AnswerColumns) -> Column:
    """``correct_count / len(numbers)`` as Python's true division."""
    return a.n_matched.cast("double") / a.n_nums.cast("double")


def sparse(a: AnswerColumns, scale: float | None = None) -> Column:
    """No tag 0; any failure 0.1; exact 1."""
    return (
        F.when(a.equation.isNull(), _l(0.0))
        .when(~a.numbers_ok, _l(0.1))
        .when(a.result.isNull(), _l(0.1))
        .when(_exact(a), _l(1.0))
        .otherwise(_l(0.1))
    )


def hybrid(a: AnswerColumns, scale: float | None = 5.0) -> Column:
    """Linear near the target, exponential far from it."""
    s = _l(scale if scale is not None else 5.0)
    d = a.distance
    base = _l(0.1) + _l(0.1)
    near = _l(0.8) * (_l(1.0) - d / (_l(2) * s))
    far = _l(0.8) * F.exp(-(d - s) / s) * _l(0.5)
    return (
        F.when(a.equation.isNull(), _l(0.0))
        .when(~a.numbers_ok, _l(0.1))
        .when(a.result.isNull(), base)
        .when(_exact(a), _l(1.0))
        .otherwise(base + _max0(F.when(py_le(d, s), near).otherwise(far)))
    )


def graded(a: AnswerColumns, scale: float | None = 5.0) -> Column:
    """R2: staged credit, think bonus; not capped at 1 (kept as in the reference)."""
    s = _l(scale if scale is not None else 5.0)
    d = a.distance
    r0 = F.when(a.has_think, _l(0.2) + _l(0.2)).otherwise(_l(0.2))
    partial = F.when(a.n_nums > 0, r0 + _l(0.1) * _share(a)).otherwise(r0)
    r1 = r0 + _l(0.2)
    r2 = r1 + _l(0.2)
    two_s = s * _l(2)
    closeness = (
        F.when(py_le(d, _l(1)), _l(0.4) * (_l(1.0) - d))
        .when(py_le(d, s), _l(0.3) * (_l(1.0) - d / s))
        .when(py_le(d, two_s), _l(0.2) * (_l(1.0) - d / two_s))
        .otherwise(_l(0.1) * F.exp(-d / two_s))
    )
    return (
        F.when(a.equation.isNull(), _l(0.0))
        .when(~a.numbers_ok, partial)
        .when(a.result.isNull(), r1)
        .when(_exact(a), _l(1.0))
        .otherwise(r2 + _max0(closeness))
    )


def format_reward(a: AnswerColumns, scale: float | None = None, max_words: int = 200) -> Column:
    """Format-first curriculum reward, capped at 1."""
    numbers = (
        F.when(a.numbers_ok, _l(0.3) + _l(0.25))
        .when(a.n_nums > 0, _l(0.3) + _l(0.75) * _share(a))
        .otherwise(_l(0.3))
    )
    length = _l(0.4) * py_min(a.n_words.cast("double") / _l(max_words), _l(1.0))
    with_length = numbers + length
    hit = a.result.isNotNull() & _exact(a)
    total = F.when(hit, with_length + _l(0.05)).otherwise(with_length)
    return F.when(a.equation.isNull(), _l(0.0)).otherwise(py_min(total, _l(1.0)))


def reason(a: AnswerColumns, scale: float | None = 5.0) -> Column:
    """Dense distance shaping for the reasoning phase."""
    s = _l(scale if scale is not None else 5.0)
    d = a.distance
    two_s, five_s = s * _l(2), s * _l(5)
    closeness = (
        F.when(py_le(d, _l(1)), _l(0.5) * (_l(1.0) - d))
        .when(py_le(d, s), _l(0.4) * (_l(1.0) - d / s))
        .when(py_le(d, two_s), _l(0.3) * (_l(1.0) - d / two_s))
        .when(py_le(d, five_s), _l(0.2) * (_l(1.0) - d / five_s))
        .otherwise(_l(0.1) * F.exp(-d / five_s))
    )
    return (
        F.when(a.equation.isNull(), _l(0.0))
        .when(~a.numbers_ok, _l(0.3))
        .when(a.result.isNull(), _l(0.5))
        .when(_exact(a), _l(1.0))
        .otherwise(_l(0.5) + _max0(closeness))
    )


def _signed_raw(a: AnswerColumns, s: Column) -> Column:
    d = a.distance
    five_s = _l(5) * s
    capped = F.when(py_lt(five_s, d), five_s).otherwise(d)  # Python min(d, 5s)
    closeness = (
        F.when(py_le(d, _l(1)), _l(0.5) * (_l(1) - d))
        .when(py_le(d, s), _l(0.3) * (_l(1) - d / s))
        .otherwise(_l(0.1) * F.exp(-capped / s))
    )
    return _l(0.4) + closeness


def _signed(a: AnswerColumns, raw_clipped: Column) -> Column:
    return (
        F.when(a.equation.isNull(), _l(-0.1))
        .when(~a.numbers_ok, _l(-0.05))
        .when(a.result.isNull(), _l(0.15))
        .when(_exact(a), _l(1.0))
        .otherwise(raw_clipped)
    )


def signed5(a: AnswerColumns, scale: float | None = 5.0) -> Column:
    """Signed reward, scale 5, clipped to [-1, 1] the way ``np.clip`` does
    (the reference calls ``np.clip`` without importing numpy; the intended
    clip is built, NaN propagates)."""
    raw = _signed_raw(a, _l(scale if scale is not None else 5.0))
    clipped = F.when(F.isnan(raw), raw).otherwise(F.least(F.greatest(raw, _l(-1.0)), _l(1.0)))
    return _signed(a, clipped)


def signed10(a: AnswerColumns, scale: float | None = 10.0) -> Column:
    """Signed reward, scale 10, ``max(-1, min(1, x))`` with Python semantics."""
    raw = _signed_raw(a, _l(scale if scale is not None else 10.0))
    return _signed(a, py_max(_l(-1.0), py_min(_l(1.0), raw)))


RewardFn = Callable[..., Column]

REWARDS: dict[str, RewardFn] = {
    "sparse": sparse,
    "hybrid": hybrid,
    "graded": graded,
    "format": format_reward,
    "reason": reason,
    "signed5": signed5,
    "signed10": signed10,
}


def register_reward(name: str, fn: RewardFn) -> None:
    """Add a user rule ``fn(AnswerColumns, scale) -> Column``."""
    if not callable(fn):
        raise TypeError("reward must be callable")
    REWARDS[name] = fn


def reward_column(name: str | RewardFn, answers: AnswerColumns | None = None, scale: float | None = None) -> Column:
    """Reward Column by registry name (or a user callable)."""
    fn = REWARDS.get(name) if isinstance(name, str) else name
    if fn is None:
        raise KeyError(f"unknown reward {name!r}; known: {sorted(REWARDS)}")
    a = answers or AnswerColumns.staged()
    return fn(a) if scale is None else fn(a, scale)


__all__ = ["AnswerColumns", "REWARDS", "register_reward", "reward_column", "EXACT_TOL"]
