"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHOLE_NUMBER = "[+-]?[0-9]+"


def _one_character(sep: str) -> None:
    if len(sep) != 1:
        raise ValueError("the separator must be one character")


def two_numbers(line: Column, sep: str) -> Column:
    """True if a line is two whole numbers, then at most trailing separators."""
    _one_character(sep)
    mark = f"(?:\\Q{sep}\\E)"
    return line.rlike(f"^{WHOLE_NUMBER}{mark}{WHOLE_NUMBER}{mark}*\\z")


def number_at(line: Column, sep: str, position: int) -> Column:
    """Field of a delimited line as BIGINT; null if it does not fit."""
    return F.split_part(line, F.lit(sep), F.lit(position)).try_cast("bigint")


def field_count(line: Column, sep: str) -> Column:
    """Number of fields of a line without its trailing empty fields."""
    _one_character(sep)
    kept = F.rtrim(line, F.lit(sep))
    bare = F.replace(kept, F.lit(sep), F.lit(""))
    return F.length(kept) - F.length(bare) + 1


def tuple_text(*columns: Column) -> Column:
    """``(a,b)`` lines."""
    return F.concat(F.lit("("), F.concat_ws(",", *columns), F.lit(")"))


def damped(total: Column, dangling: Column, nodes: int, damping: float) -> Column:
    """PageRank update of one node from the rank mass that reaches it."""
    return F.lit((1.0 - damping) / nodes) + damping * (total + dangling / F.lit(nodes))
