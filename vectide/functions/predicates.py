"""Filter strings and output field lists.

Filters are Spark SQL predicates. One form that Spark SQL lacks, ``x in [1, 2]``,
is rewritten; the other foreign forms are refused with a clear message.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# A quoted literal, or a run of text outside of quotes.
_PIECES = re.compile(r"""("(?:\\.|[^"\\])*"|'(?:\\.|[^'\\])*')""", re.S)
_OPEN_LIST = re.compile(r"\bin\s*\[", re.I)
_CHAINED = re.compile(r"[\w.]+\s*(?:<=?|>=?)\s*[\w.]+\s*(?:<=?|>=?)\s*[\w.]+")


def rewrite(text: str) -> str:
    """A filter string as a Spark SQL predicate."""
    if text is None or not text.strip():
        raise ValueError("filter must not be empty")
    out, depth = [], 0
    for i, piece in enumerate(_PIECES.split(text)):
        if i % 2:
            out.append(piece)
            continue
        for sign in ("&&", "||"):
            if sign in piece:
                raise ValueError(f"{sign!r} is not supported in a filter; write and / or")
        if _CHAINED.search(piece):
            raise ValueError("chained comparisons are not supported in a filter; join them with and")
        opened = len(_OPEN_LIST.findall(piece))
        piece = _OPEN_LIST.sub("in (", piece)
        depth += opened
        closed = piece.count("]")
        if "[" in piece or closed > depth:
            raise ValueError("brackets are supported only as x in [a, b]")
        depth -= closed
        out.append(piece.replace("]", ")"))
    if depth:
        raise ValueError("unclosed list in filter")
    return "".join(out)


def predicate(filter: str | Column) -> Column:
    return F.expr(rewrite(filter)) if isinstance(filter, str) else filter


def fields_list(fields: Sequence[str] | str | None, everything: Sequence[str]) -> list[str]:
    """Names in a comma list; ``*`` is every field, nothing is no field."""
    if fields is None:
        return []
    names = fields.split(",") if isinstance(fields, str) else list(fields)
    names = [n.strip() for n in names if n.strip()]
    if "*" in names:
        return list(everything)
    unknown = [n for n in names if n.split(".")[0] not in everything]
    if unknown:
        raise ValueError(f"unknown output fields: {', '.join(unknown)}")
    return list(dict.fromkeys(names))
