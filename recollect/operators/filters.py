"""Metadata filters: a nested mapping compiled to one Column.

Values: a scalar (equal), ``"*"`` (present), or a mapping of operators. ``AND``, ``OR`` and ``NOT`` take lists. Every
condition is two-valued - an absent key fails a test and passes its negation - and the scope is always ANDed, so a
specification can narrow a scope but never widen it.

Keys are free: one that the rows do not have is absent, an empty array counts as absent, and an operand of another type than the
column's (a number for a text, a range on a text, a text for a boolean) matches nothing. An array matches if any of its elements does.
Nothing is cast, so no row can make a filter fail. A text operand without any token matches nothing.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recollect.functions.text import has_all_tokens, whole_tokens

RANGES = {"gt": Column.__gt__, "gte": Column.__ge__, "lt": Column.__lt__, "lte": Column.__le__}
LOGICAL = ("AND", "OR", "NOT")
OPERATORS = ("eq", "ne", "in", "nin", *RANGES, "contains", "icontains")


class FilterError(ValueError):
    """All faults of a specification, with their paths."""


def _scalar(v: Any) -> bool:
    return isinstance(v, (str, int, float, bool))


def _operand_fault(op: str, v: Any) -> str | None:
    if op not in OPERATORS:
        return f"unknown operator {op!r}"
    if op in RANGES and (isinstance(v, bool) or not isinstance(v, (int, float))):
        return f"{op} takes a number"
    if op in ("in", "nin") and (not isinstance(v, list) or not v or not all(map(_scalar, v))):
        return f"{op} takes a non-empty list of scalars"
    if op in ("contains", "icontains") and (not isinstance(v, str) or not v):
        return f"{op} takes a non-empty string"
    if op in ("eq", "ne") and not _scalar(v):
        return f"{op} takes a scalar"
    return None


def _scope_fault(test: Any, own: Any) -> str | None:
    """Why a condition on a scope key contradicts the scope."""
    tests = test.items() if isinstance(test, dict) else [("eq", test)]
    for op, v in tests:
        agrees = {"eq": lambda v=v: v in (own, "*"), "ne": lambda v=v: v != own, "in": lambda v=v: own in v, "nin": lambda v=v: own not in v}.get(op)
        if agrees is None:
            return f"{op} is not allowed on a scope key"
        if not agrees():
            return "contradicts the scope"
    return None


def faults(spec: Any, scope: dict[str, Any] | None = None, path: str = "") -> list[str]:
    """Every fault of a specification; empty if it can be compiled."""
    if not isinstance(spec, dict):
        return [f"{path or 'filter'}: a mapping is needed"]
    if not spec and path:
        return [f"{path}: empty mapping"]
    out = []
    for key, test in spec.items():
        at = f"{path}.{key}" if path else str(key)
        if not isinstance(key, str):
            out.append(f"{at}: keys are strings")
        elif key in LOGICAL:
            if not isinstance(test, list) or not test:
                out.append(f"{at}: a non-empty list is needed")
            else:
                out += [f for i, child in enumerate(test) for f in faults(child, scope, f"{at}[{i}]")]
        else:
            own = []
            if isinstance(test, dict):
                own = [f"{at}: empty mapping"] if not test else [f"{at}: {f}" for op, v in test.items() if (f := _operand_fault(op, v))]
            elif not _scalar(test):
                own = [f"{at}: a scalar or a mapping is needed"]
            if not own and scope and key in scope and (f := _scope_fault(test, scope[key])):
                own = [f"{at}: {f}"]
            out += own
    return out


def _holds(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _comparable(kind: T.DataType, v: Any) -> bool:
    """Whether values of the column's type can equal the operand."""
    if isinstance(v, bool):
        return isinstance(kind, T.BooleanType)
    return isinstance(kind, T.NumericType if isinstance(v, (int, float)) else T.StringType)


def _hit(column: Column, kind: T.DataType, op: str, v: Any) -> Column:
    """Whether one value passes a positive test; null and values of other types do not."""
    if op in RANGES:
        return _holds(RANGES[op](column, F.lit(v))) if isinstance(kind, T.NumericType) else F.lit(False)
    if op in ("contains", "icontains"):
        return _holds(column.isNotNull() & (F.size(whole_tokens(F.lit(v))) > 0) & has_all_tokens(column, F.lit(v))) if isinstance(kind, T.StringType) else F.lit(False)
    fit = [x for x in (v if op in ("in", "nin") else [v]) if _comparable(kind, x)]
    return _holds(column.isin(fit)) if fit else F.lit(False)


def _test(key: str, schema: T.StructType, op: str, v: Any) -> Column:
    kind = schema[key].dataType if key in schema.names else None
    name = F.col(f"`{key}`")
    if kind is None:
        hit = F.lit(False)
    elif isinstance(kind, T.ArrayType):
        hit = _holds(F.exists(name, lambda x: _hit(x, kind.elementType, op, v)))
    else:
        hit = _hit(name, kind, op, v)
    return ~hit if op in ("ne", "nin") else hit


def _present(key: str, schema: T.StructType) -> Column:
    if key not in schema.names:
        return F.lit(False)
    name = F.col(f"`{key}`")
    return _holds(F.size(name) > 0) if isinstance(schema[key].dataType, T.ArrayType) else name.isNotNull()


def _compile(spec: dict[str, Any], schema: T.StructType) -> Column:
    parts = []
    for key, test in spec.items():
        if key == "AND":
            parts += [_compile(c, schema) for c in test]
        elif key == "OR":
            parts.append(reduce(or_, [_compile(c, schema) for c in test]))
        elif key == "NOT":
            parts += [~_compile(c, schema) for c in test]
        elif test == "*":
            parts.append(_present(key, schema))
        else:
            parts += [_test(key, schema, op, v) for op, v in (test.items() if isinstance(test, dict) else [("eq", test)])]
    return reduce(and_, parts) if parts else F.lit(True)


def where(schema: T.StructType, spec: dict[str, Any] | None = None, scope: dict[str, Any] | None = None, include_archived: bool = False) -> Column:
    """Condition of a specification within a scope, for rows of a schema; archived rows are out unless they are asked for."""
    found = faults(spec or {}, scope)
    if found:
        raise FilterError("; ".join(found))
    parts = [_test(k, schema, "eq", v) for k, v in (scope or {}).items()]
    if not include_archived:
        parts.append(~_test("archived", schema, "eq", True))
    return reduce(and_, [*parts, _compile(spec or {}, schema)])


def matching(rows: DataFrame, spec: dict[str, Any] | None = None, scope: dict[str, Any] | None = None, include_archived: bool = False) -> DataFrame:
    """The rows that a specification lets through, within a scope."""
    return rows.where(where(rows.schema, spec, scope, include_archived))
