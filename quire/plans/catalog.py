"""All queries of the core, by name, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quire.operators import chapters, cleaning, cleanup, footnotes, maps, margins, pages, responses, review
from quire.operators import tables as markdown_tables
from quire.sources import tables
from quire.streaming import events

_MODULES = [tables, pages, margins, footnotes, chapters, maps, cleanup, cleaning, markdown_tables, review, responses, events]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assembled books: pages, chapters, words, blank pages and fidelity of each book."""
    return chapters.q_books(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict = {}
    for m in _MODULES:
        out |= m.QUERIES
    return out


def oracle_sql() -> dict[str, str]:
    out: dict = {}
    for m in _MODULES:
        out |= m.SQL
    return out
