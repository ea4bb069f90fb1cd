"""Counters that a stage takes while it writes, instead of a second run over its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation


def observed(df: DataFrame, counters: Observation | str | None, columns: dict[str, Column]) -> DataFrame:
    """df, with these aggregates of its rows kept in `counters` (if given) when it's next computed; a stream names them instead, and its progress tells them.

    Rows must be computed once for that: a global sort above samples what lies below it, so there must be a shuffle between
    (as in jsonl.write). If adaptive execution replaces a plan by an empty one, its counters are lost with it; the command
    line's session therefore leaves that rule out.
    """
    return df if counters is None else df.observe(counters, *[c.alias(k) for k, c in columns.items()])
