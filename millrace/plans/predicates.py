"""Predicates as values: rendered as SQL text for a remote scan, or turned into Spark columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Field:
    name: str
    boolean: bool = False


@dataclass(frozen=True)
class Value:
    of: Any


@dataclass(frozen=True)
class Cast:
    of: Any
    kind: str


@dataclass(frozen=True)
class Call:
    op: str
    args: tuple


#: Operations with a text form.
_INFIX = {"eq": "=", "ne": "<>", "gt": ">", "ge": ">=", "lt": "<", "le": "<=", "and": "and", "or": "or"}
_POSTFIX = {"is_null": "is null", "is_not_null": "is not null", "not": "= false"}


def render(e: Any) -> str | None:
    """The SQL text of an expression, or None if any part has none: such a predicate stays with Spark as a whole.

    Casts are written out; dropping them would change which rows match.
    """
    if isinstance(e, Field):
        return e.name
    if isinstance(e, Value):
        if isinstance(e.of, (dt.date, dt.datetime, str)):
            return "'" + str(e.of).replace("'", "''") + "'"
        return str(e.of).lower() if isinstance(e.of, bool) else str(e.of)
    if isinstance(e, Cast):
        inner = render(e.of)
        return inner and f"cast({inner} as {e.kind})"
    if isinstance(e, Call):
        parts = [render(a) for a in e.args]
        if None in parts:
            return None
        if e.op in _INFIX and len(parts) == 2:
            return f"({parts[0]} {_INFIX[e.op]} {parts[1]})"
        if e.op in _POSTFIX and len(parts) == 1:
            return f"({parts[0]} {_POSTFIX[e.op]})"
    return None


def push_down(conjuncts: Sequence[Any]) -> tuple[str, list[Any], list[Any]]:
    """The text of all conjuncts that have one, those, and the rest, which Spark must still apply."""
    texts, accepted, rest = [], [], []
    for e in conjuncts:
        whole = Call("eq", (e, Value(True))) if isinstance(e, Field) and e.boolean else e
        text = render(whole)
        if text is None or isinstance(whole, (Field, Value, Cast)):
            rest.append(e)
        else:
            texts.append(text)
            accepted.append(e)
    return " and ".join(texts), accepted, rest


def to_column(e: Any) -> Column:
    """The same expression for Spark, whose optimizer pushes what it can into the scan."""
    if isinstance(e, Field):
        return F.col(e.name)
    if isinstance(e, Value):
        return F.lit(e.of)
    if isinstance(e, Cast):
        return to_column(e.of).cast(e.kind)
    a = [to_column(x) for x in e.args]
    simple = {
        "eq": lambda: a[0] == a[1], "ne": lambda: a[0] != a[1], "gt": lambda: a[0] > a[1], "ge": lambda: a[0] >= a[1],
        "lt": lambda: a[0] < a[1], "le": lambda: a[0] <= a[1], "and": lambda: a[0] & a[1], "or": lambda: a[0] | a[1],
        "is_null": lambda: a[0].isNull(), "is_not_null": lambda: a[0].isNotNull(), "not": lambda: ~a[0],
        "like": lambda: a[0].like(e.args[1].of), "in": lambda: a[0].isin(*[x.of for x in e.args[1:]]),
        "between": lambda: a[0].between(a[1], a[2]), "char_length": lambda: F.char_length(a[0]),
    }
    if e.op not in simple:
        raise ValueError(f"unknown operation {e.op}")
    return simple[e.op]()
