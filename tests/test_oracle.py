"""Every core query with a SQL twin gives the twin's rows."""

import pandas as pd
import pytest

from quire.plans import catalog

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


def plain(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return f"{v:.6g}"
    v = v.tolist() if hasattr(v, "tolist") else v
    return "[" + ",".join(map(plain, v)) + "]" if isinstance(v, list) else str(v)


def rows(df):
    df = df[sorted(df.columns)]
    return list(df.columns), sorted(tuple(map(plain, r)) for r in df.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, sf_dir, name):
    assert rows(QUERIES[name](spark, sf_dir).toPandas()) == rows(duck.sql(SQL[name]).df())


#: Columns that a query without a twin has, and whose values are unique.
KEYS = {
    "structure_payload": ["extraction_id"], "extraction_decision": ["extraction_id"], "footnotes_from_pages": ["extraction_id", "ord"], "block_styles": ["chapter_id", "line_start"], "segment_merge": ["extraction_id"],
    "toc_targets": ["extraction_id", "line_no"], "footnote_markers": ["extraction_id"], "footnote_healed": ["chapter_id"],
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir).toPandas()
    assert len(df) and not df.duplicated(KEYS[name]).any()


#: Queries that find nothing in the smallest tables; their operators have hand-made cases.
MAY_BE_EMPTY = {"pending_pages", "footnote_reconcile", "footnote_siblings", "table_header_restarts", "title_issues", "page_tables", "blank_page_ranges", "running_margins", "stream_event_bursts"}


@pytest.mark.parametrize("name", sorted(set(SQL) - MAY_BE_EMPTY))
def test_has_rows(duck, name):
    assert len(duck.sql(SQL[name]).df())
