"""evaluate an arithmetic equation with Python integer semantics.

This is the one operator that is not a Catalyst expression: answers are
evaluated with exact integers (``9007199254740993-9007199254740992`` is 1,
which DOUBLE arithmetic gets wrong), ``//`` floors, ``**`` may turn into a
float, and every error is NULL. The per-row helper parses with ``ast`` and
walks a whitelist of nodes -- it never calls ``eval``.

The Spark side is an Arrow UDF that dictionary-encodes each batch, so a
repeated equation (a group of G samples often repeats itself, and one answer
may hold a large share of all rows) is evaluated once per batch, without a
shuffle. A native character guard runs first, so text that cannot be an
equation never crosses into Python.
"""

from __future__ import annotations

import ast
import operator
import re
import sys
import warnings

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._util import as_col
from .text import WS

# Fixed value that must equal the reference: the allowed character set.
_PY_GUARD = re.compile(r"[0-9+\-*/()\s]+")
JAVA_GUARD = r"\A[0-9+\-*/()" + WS[1:-1] + r"]+\z"


class _Reject(Exception):
    pass


# A power of more bits than this stays unevaluated until its exact value is
# needed; a matter of representation, results do not depend on it.
_LAZY_BITS = 1 << 16


class _Huge:
    """An integer of magnitude at least 2**low (and below 2**high), computed only on demand."""

    def __init__(self, sign: int, low: int, high: int, exact):
        self.sign, self.low, self.high, self.exact = sign, low, high, exact

    def __float__(self):
        raise OverflowError("int too large to convert to float")  # low is far above 1024

    def value(self) -> int:
        if self.high > sys.maxsize:  # no address space holds it
            raise MemoryError
        return self.exact()


def _bits(a) -> tuple[int, int]:
    """(low, high) with 2**low <= abs(a) < 2**high, for a nonzero integer."""
    return (a.low, a.high) if isinstance(a, _Huge) else (a.bit_length() - 1, a.bit_length())


def _sign(a) -> int:
    return a.sign if isinstance(a, _Huge) else (a > 0) - (a < 0)


def _value(a):
    return a.value() if isinstance(a, _Huge) else a


def _lazy(plain, rule):
    """``plain`` on ordinary numbers; ``rule`` first where a huge integer takes part (None: compute exactly)."""

    def run(a, b):
        if not isinstance(a, _Huge) and not isinstance(b, _Huge):
            return plain(a, b)
        if not isinstance(a, (int, _Huge)) or not isinstance(b, (int, _Huge)):
            raise OverflowError  # the other operand is a float: so must this become
        out = rule(a, b)
        return plain(_value(a), _value(b)) if out is None else out

    return run


def _mul_huge(a, b):
    if not _sign(a) or not _sign(b):
        return 0
    (la, ha), (lb, hb) = _bits(a), _bits(b)
    return _Huge(_sign(a) * _sign(b), la + lb, ha + hb, lambda: _value(a) * _value(b))


def _sum_huge(a, b, flip=1):
    if not _sign(b):
        return a
    if not _sign(a):
        return b if flip > 0 else _neg(b)
    (la, ha), (lb, hb) = _bits(a), _bits(b)
    sign = _sign(a) if la > hb else flip * _sign(b) if lb > ha else 0
    if sign:
        return _Huge(sign, max(la, lb) - 1, max(ha, hb) + 1, lambda: _value(a) + flip * _value(b))
    return None


def _floor_huge(a, b):
    if isinstance(b, _Huge) and (not _sign(a) or _bits(a)[1] <= b.low):  # abs(a) < abs(b)
        return -1 if _sign(a) * _sign(b) < 0 else 0
    return None


def _true_huge(a, b):
    if _sign(a) and _sign(b) and _bits(a)[0] - _bits(b)[1] > 1024:
        raise OverflowError("integer division result too large for a float")
    if isinstance(b, _Huge) and (not _sign(a) or b.low - _bits(a)[1] > 1100):
        return -0.0 if (_sign(a) < 0) != (_sign(b) < 0) else 0.0
    return None


def _neg(a):
    return _Huge(-a.sign, a.low, a.high, lambda: -a.value()) if isinstance(a, _Huge) else -a


def _pow(a, b):
    whole = isinstance(a, (int, _Huge)) and isinstance(b, (int, _Huge))
    if not whole:
        if isinstance(a, _Huge) or isinstance(b, _Huge):
            raise OverflowError
        return a**b
    if isinstance(b, _Huge) and b.sign < 0 or isinstance(a, _Huge) and _sign(b) < 0:
        raise OverflowError  # Python turns both into floats
    if isinstance(a, _Huge) and not _sign(b):
        return 1
    if isinstance(b, _Huge) and not isinstance(a, _Huge) and abs(a) <= 1:
        return a if a >= 0 or b.value() % 2 else 1
    if _sign(b) <= 0 or not _sign(a):
        return a**b
    low, high = _bits(a)
    n = 1 << min(b.low, 64) if isinstance(b, _Huge) else b  # at least b, far beyond memory if cut
    if high * n <= _LAZY_BITS:
        return a**b
    if low == 0:  # 1 and -1
        return a if a > 0 or b % 2 else 1
    odd = a.sign if isinstance(a, _Huge) else _sign(a)
    sign = 1 if odd > 0 else (-1 if _value(b) % 2 else 1)
    return _Huge(sign, low * n, high * n, lambda: _value(a) ** _value(b))


_BINARY = {
    ast.Add: _lazy(operator.add, _sum_huge),
    ast.Sub: _lazy(operator.sub, lambda a, b: _sum_huge(a, b, -1)),
    ast.Mult: _lazy(operator.mul, _mul_huge),
    ast.Div: _lazy(operator.truediv, _true_huge),
    ast.FloorDiv: _lazy(operator.floordiv, _floor_huge),
    ast.Pow: _pow,
}
_UNARY = {ast.UAdd: lambda a: a, ast.USub: _neg}


def _walk(root):
    """Value of an expression tree, depth first with a stack of its own: depth is Python's parser's business."""
    todo, values = [(root, False)], []
    while todo:
        node, ready = todo.pop()
        if isinstance(node, ast.Constant) and type(node.value) is int:
            values.append(node.value)
        elif isinstance(node, ast.BinOp) and type(node.op) in _BINARY:
            if ready:
                right = values.pop()
                values.append(_BINARY[type(node.op)](values.pop(), right))
            else:
                todo += [(node, True), (node.right, False), (node.left, False)]
        elif isinstance(node, ast.UnaryOp) and type(node.op) in _UNARY:
            if ready:
                values.append(_UNARY[type(node.op)](values.pop()))
            else:
                todo += [(node, True), (node.operand, False)]
        else:
            raise _Reject(type(node).__name__)
    return values.pop()


# Fast path: text of digits, + - * /, parentheses and plain spaces. How Python
# parses it depends on its shape alone, the text with every number written as
# 1, so a shape is parsed once (by ``ast``, as any other text) into steps that
# then run on the numbers of each text with the operators of the full walk.
# Numbers with leading zeros, ``**``, ``//``, tabs and newlines are left to
# ``ast`` text by text, and so is text long enough to meet Python's limits on
# nesting.
_SHORT = 150
_SIMPLE = re.compile(r"[0-9+\-*/() ]+")
_NOT_SIMPLE = re.compile(r"\*\*|//|(?:^|[^0-9])0[0-9]")
_NUMBERS = re.compile(r"[0-9]+")
_PLAIN = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: operator.truediv}
_SIGNS = {ast.UAdd: operator.pos, ast.USub: operator.neg}
_SHAPES_MAX = 1 << 14


def _parse(text: str):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", SyntaxWarning)
        # eval() of a string drops leading spaces and tabs before parsing.
        return ast.parse(text.lstrip(" \t"), mode="eval").body


def _steps(shape: str) -> list | None:
    """The steps of a shape, operands first: None takes the next number, (arity, operator) what was computed last. No
    list at all where Python refuses the shape or it holds anything but the plain operators: no such text has a value."""
    try:
        todo, steps = [_parse(shape)], []
    except Exception:  # noqa: BLE001 -- Python refuses the text
        return None
    while todo:  # from the right and the root on, turned round at the end
        node = todo.pop()
        if isinstance(node, ast.Constant):
            steps.append(None)
        elif isinstance(node, ast.BinOp) and type(node.op) in _PLAIN:
            steps.append((2, _PLAIN[type(node.op)]))
            todo += [node.left, node.right]
        elif isinstance(node, ast.UnaryOp) and type(node.op) in _SIGNS:
            steps.append((1, _SIGNS[type(node.op)]))
            todo.append(node.operand)
        else:
            return None
    return steps[::-1]


class _Shapes(dict):
    """Steps of the shapes seen by one worker."""

    def __missing__(self, shape: str) -> list | None:
        if len(self) >= _SHAPES_MAX:
            self.clear()
        steps = self[shape] = _steps(shape)
        return steps


_shapes = _Shapes()


def _run(steps: list, columns: list[list[int]]) -> list:
    """The steps on many texts at once: one column per number of the shape, one entry per text."""
    at, values = 0, []
    for step in steps:
        if step is None:
            values.append(columns[at])
            at += 1
        else:
            arity, op = step
            operands = values[-arity:]
            del values[-arity:]
            values.append(list(map(op, *operands)))
    return values[0]


def _values(shape: str, texts: list[str]) -> list[float | None]:
    """Values of texts of one shape. Where one of them has an arithmetic error, halves are tried by themselves."""
    steps = _shapes[shape]
    if steps is None:
        return [None] * len(texts)
    numbers = list(map(int, _NUMBERS.findall("\n".join(texts))))
    k = len(numbers) // len(texts)
    try:
        return list(map(float, _run(steps, [numbers[i::k] for i in range(k)])))
    except Exception:  # noqa: BLE001 -- arithmetic errors: not evaluable
        half = len(texts) // 2
        return _values(shape, texts[:half]) + _values(shape, texts[half:]) if half else [None]


def _evaluate_full(text: str) -> float | None:
    try:
        if len(text) > _SHORT:
            with warnings.catch_warnings():
                warnings.simplefilter("ignore", SyntaxWarning)
                # Not run: text that Python refuses for its depth fails here.
                compile(text.lstrip(" \t"), "<equation>", "eval")
        return float(_walk(_parse(text)))
    except Exception:  # noqa: BLE001 -- any failure means "not evaluable"
        return None


def _evaluate(text: str) -> float | None:
    if not _PY_GUARD.fullmatch(text):
        return None
    if len(text) <= _SHORT and _SIMPLE.fullmatch(text) and not _NOT_SIMPLE.search(text):
        return _values(_NUMBERS.sub("1", text), [text])[0]
    return _evaluate_full(text)


# Per worker process, so an answer repeated across batches (a hot key) that is
# not evaluated by its shape is evaluated once per executor. Only short texts are cached, which bounds the
# cache to about 64k x 256 characters whatever the answers look like.
_CACHE_MAX_CHARS = 256
_CACHE_ENTRIES = 1 << 16


class _Cache(dict):
    """Values of equations seen by one worker; travels to workers empty."""

    def __missing__(self, text: str) -> float | None:
        if len(self) >= _CACHE_ENTRIES:
            self.clear()
        value = self[text] = _evaluate(text)
        return value

    def __reduce__(self):
        return _Cache, ()


_cached = _Cache()


def evaluate_equation_py(text: str | None) -> float | None:
    """Value of ``text`` as Python would compute it, or None on any error."""
    if text is None:
        return None
    return _cached[text] if len(text) <= _CACHE_MAX_CHARS else _evaluate(text)


def _evaluate_arrow(equations: pa.Array) -> pa.Array:
    if isinstance(equations, pa.ChunkedArray):
        equations = equations.combine_chunks()
    encoded = equations.dictionary_encode()
    texts = encoded.dictionary
    simple = pc.and_(pc.less_equal(pc.binary_length(texts), _SHORT), pc.match_substring_regex(texts, f"^{_SIMPLE.pattern}$"))
    simple = pc.and_not(simple, pc.match_substring_regex(texts, _NOT_SIMPLE.pattern))
    values = [None] * len(texts)
    for i in pc.indices_nonzero(pc.invert(simple)).to_pylist():
        values[i] = evaluate_equation_py(texts[i].as_py())
    rows = pc.indices_nonzero(simple)
    shapes = pc.replace_substring_regex(texts.take(rows), _NUMBERS.pattern, "1").dictionary_encode()
    order = pc.sort_indices(shapes.indices)  # texts of one shape side by side
    rows, at = rows.take(order), 0
    sorted_rows, sorted_texts = rows.to_pylist(), texts.take(rows).to_pylist()
    for shape, n in zip(shapes.dictionary.to_pylist(), np.bincount(shapes.indices, minlength=len(shapes.dictionary)).tolist()):
        for i, value in zip(sorted_rows[at : at + n], _values(shape, sorted_texts[at : at + n])):
            values[i] = value
        at += n
    return pa.array(values, type=pa.float64()).take(encoded.indices)


_evaluate_udf = F.arrow_udf(_evaluate_arrow, T.DoubleType())


_DEALT = 4096


def _has_map(kind: T.DataType) -> bool:
    """Whether Spark cannot hash the type."""
    return "map<" in kind.simpleString() or "variant" in kind.simpleString()


def equation_guard(equation) -> Column:
    """Native pre-check: only these characters can form an evaluable equation."""
    return F.coalesce(as_col(equation).rlike(JAVA_GUARD), F.lit(False))


def evaluate_equation(equation) -> Column:
    """F3 as a Column: DOUBLE value or NULL."""
    e = as_col(equation)
    return _evaluate_udf(F.when(equation_guard(e), e))


def with_equation_result(
    df: DataFrame, equation: str = "equation", out: str = "result", strategy: str = "batch"
) -> DataFrame:
    """Add ``out`` = F3(``equation``).

    ``batch`` (default): evaluate in place, de-duplicated per Arrow batch; no
    shuffle, hot equations cost nothing extra.
    ``distinct`` (J4): evaluate the distinct equations once across the whole
    input and join the values back. Worth it only when the same equations
    repeat across far-apart rows; it costs a shuffle of equations plus the
    join (AQE splits a hot equation on the probe side).
    """
    if strategy == "batch":
        return df.withColumn(out, evaluate_equation(F.col(equation)))
    if strategy == "distinct":
        key = "__equation_key"
        lookup = (
            df.select(F.col(equation).alias(key))
            .where(equation_guard(F.col(key)))
            .distinct()
            .withColumn(out, _evaluate_udf(F.col(key)))
        )
        # Text that is no equation has no value to find; it is dealt by its row, or all of it would meet in one task.
        other = F.pmod(F.xxhash64(*[f.name for f in df.schema if not _has_map(f.dataType)]), F.lit(_DEALT)).cast("string")
        probe = df.withColumn("__probe", F.when(equation_guard(F.col(equation)), F.col(equation)).otherwise(F.concat(F.lit("row "), other)))
        joined = probe.join(lookup, probe["__probe"] == lookup[key], "left")
        return joined.drop(key, "__probe")
    raise ValueError(f"unknown strategy {strategy!r}; use 'batch' or 'distinct'")
