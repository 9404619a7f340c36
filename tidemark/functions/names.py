"""Column-name resolution: exact match first, then the folded form.

A simple name (ASCII letter, then letters, digits, ``_ $ #``) is folded to
upper case for comparison; anything else is compared as written.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from tidemark.errors import ColumnMismatch

_SIMPLE = re.compile(r"[A-Za-z][A-Za-z0-9_$#]*")


def fold_name(name: str) -> str:
    return name.upper() if _SIMPLE.fullmatch(name) else name


def quote_exact(name: str) -> str:
    """A name from a database's catalog as a quoted SQL identifier, as it is."""
    return '"' + name.replace('"', '""') + '"'


def quote_name(name: str) -> str:
    """A name given by a user as a quoted SQL identifier: folded if it is simple."""
    return quote_exact(fold_name(name))


def quote_path(name: str) -> str:
    """A possibly multi-part table name (``schema.table``), quoted part by part."""
    return ".".join(quote_name(part) for part in name.split("."))


def position(columns: Sequence[str], name: str) -> int:
    """Index of ``name`` in ``columns``; none or several matches is an error."""
    hits = [i for i, c in enumerate(columns) if c == name]
    if not hits:
        hits = [i for i, c in enumerate(columns) if fold_name(c) == fold_name(name)]
    if len(hits) != 1:
        what = "is ambiguous in" if hits else "is not one of"
        raise ColumnMismatch(f"column {name!r} {what} {list(columns)}")
    return hits[0]


def resolve(columns: Sequence[str], name: str) -> str:
    return columns[position(columns, name)]


def resolve_all(columns: Sequence[str], names: Iterable[str]) -> list[str]:
    return [resolve(columns, n) for n in names]


def ref(name: str) -> str:
    """A column reference that keeps dots and backticks in the name literal."""
    return "`" + name.replace("`", "``") + "`"
