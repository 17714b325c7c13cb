"""Constant-time lookups: vocabularies as constants of the plan, indexed by
code point, byte or id (JON1).

A vocabulary has a bound of its own (the code points, the vocabulary-size
parameter), so it is a constant whatever the data's size: a dense array, which
an expression reads by position. The constants are written as JSON, one
literal each, and the optimizer folds them before the first task starts.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

PAGE = 256      # code points per page of the character table


def constant(value, schema: str) -> Column:
    """A nested constant of the plan."""
    return F.from_json(F.lit(json.dumps(value, separators=(",", ":"))), schema)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is named."""
    return F.transform(F.array(value), body)[0]


def dense(pairs: Iterable[tuple[int, object]]) -> list:
    """List with ``value`` at each ``index``, null elsewhere."""
    pairs = list(pairs)
    out: list = [None] * (max((i for i, _ in pairs), default=-1) + 1)
    for i, v in pairs:
        out[i] = v
    return out


def char_pages(ids: Iterable[tuple[str, int]]) -> Column:
    """Ids of single characters, as pages of ``PAGE`` code points."""
    pages: dict[int, list] = {}
    for token, i in ids:
        if len(token) == 1:
            pages.setdefault(ord(token) // PAGE, [None] * PAGE)[ord(token) % PAGE] = i
    return constant(dense(pages.items()), "array<array<int>>")


def char_id(pages: Column, char: Column) -> Column:
    """Id of a character (``ascii`` gives the code point), null if it has none."""
    point = F.ascii(char)
    return F.get(F.get(pages, F.floor(point / PAGE).cast("int")), point % PAGE)


def by_id(rows: Iterable[tuple[int, object]], kind: str) -> Column:
    """Dense array of values by id, for :func:`pyspark.sql.functions.get`."""
    return constant(dense(rows), f"array<{kind}>")
