"""Arithmetic that comes as text."""

from __future__ import annotations

import ast
import math
import operator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_BINARY = {
    ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: operator.truediv,
    ast.FloorDiv: operator.floordiv, ast.Mod: operator.mod, ast.Pow: operator.pow,
}
_NAMES = {"pi": math.pi, "e": math.e}
_CALLS = {"sqrt": math.sqrt, "abs": abs, "round": round, "min": min, "max": max, "log": math.log, "exp": math.exp, "floor": math.floor, "ceil": math.ceil}


def evaluate(text: str) -> float | None:
    """The value of an expression of numbers, ``+ - * / // % **`` (or ``^``), brackets, and a few functions; None if it has none."""

    def value(node):
        if isinstance(node, ast.Constant) and type(node.value) in (int, float):
            return float(node.value)
        if isinstance(node, ast.Name):
            return _NAMES[node.id]
        if isinstance(node, ast.UnaryOp) and isinstance(node.op, (ast.UAdd, ast.USub)):
            return value(node.operand) * (-1.0 if isinstance(node.op, ast.USub) else 1.0)
        if isinstance(node, ast.BinOp):
            return _BINARY[type(node.op)](value(node.left), value(node.right))
        if isinstance(node, ast.Call) and isinstance(node.func, ast.Name) and not node.keywords:
            return _CALLS[node.func.id](*map(value, node.args))
        raise ValueError("no arithmetic")

    try:
        out = float(value(ast.parse(text.strip().replace("^", "**"), mode="eval").body))
    except (ValueError, TypeError, KeyError, SyntaxError, ArithmeticError, RecursionError, MemoryError):
        return None
    return out if math.isfinite(out) else None


def calculate(expression: Column) -> Column:
    """``evaluate`` of each text, as a double; null for null and for what is no arithmetic."""

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else evaluate(t) for t in texts.to_pylist()], pa.float64())

    return F.arrow_udf(run, "double")(expression)
