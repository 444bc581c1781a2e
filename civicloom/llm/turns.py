"""Turns of conversations in order, without a window over a whole conversation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicloom.operators.numbering import number_rows


def mark_of(role: Column, text: Column) -> Column:
    """SHA-256 of a role and a text, neither of them null."""
    size = F.octet_length(role).cast("string")
    return F.unhex(F.sha2(F.concat(size, F.lit(":"), role, text), 256))


def in_order(turns: DataFrame, conv_col: str, turn_col: str, mark_col: str) -> tuple[DataFrame, DataFrame]:
    """``turns`` with ``number``, counting over all rows in order of conversation, turn (null
    first) and mark, and the ``start`` of each conversation: ``(conv_col, start, rows)``.

    Numbers come from a global sort that tells copies apart, so a conversation that holds a third
    of all rows is sorted by many tasks. Texts need not come along: equal marks, equal texts.
    """
    numbered = number_rows(turns, [conv_col, turn_col, mark_col], "number")
    starts = numbered.groupBy(conv_col).agg(F.min("number").alias("start"), F.count("*").alias("rows"))
    return numbered, starts
