"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from tidemark.plans import catalogue


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for f in os.listdir(sf_dir):
        if f.endswith(".parquet"):
            c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{sf_dir}/{f}')")
    return c


def test_each_query_has_sql():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, con, sf_dir, name):
    got = catalogue.QUERIES[name](spark, sf_dir)
    want = con.sql(catalogue.ORACLE_SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    order = [want.columns.index(c) for c in columns]
    assert sorted(repr(tuple(r[c] for c in columns)) for r in got.collect()) == sorted(repr(tuple(r[i] for i in order)) for r in want.fetchall())


@pytest.mark.parametrize("name", ["page_text", "enrich_full_outer"])
def test_pages_cut_within_a_reference(spark, con, sf_dir, tmp_path, name):
    for table in ("customer", "supplier", "nation"):
        os.symlink(f"{sf_dir}/{table}.parquet", tmp_path / f"{table}.parquet")
    pages = ["<title>a &amp b &am</title><p>x &copy; &quot;y&quot; &lt</p>", "<title>a &quot;b&quot; &amp; c </title>&notit; &eacute; &amp;lt;"]
    spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    query, own = catalogue.QUERIES[name](spark, str(tmp_path)), duckdb.connect()
    for table in ("customer", "supplier", "nation"):
        own.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}.parquet')")
    own.sql(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    want = own.sql(catalogue.ORACLE_SQL[name])
    assert sorted(repr(tuple(r)) for r in query.select(*want.columns).collect()) == sorted(map(repr, want.fetchall()))


def test_a_sync_of_texts_that_are_null_or_blank_or_have_other_line_ends(spark, tmp_path):
    texts = [None, "", " ", "\n", "\t", "\r", "\x85", "\u2028", "\xa0", "a\rb", "ab\r\n" * 900, "\x1c" * 1700, "y" * 3200, "y" * 1599 + "\r" + "y" * 1599 + " ", "plain"]
    rows = [(i, texts[i % len(texts)], [None, "en"][i % 2]) for i in range(385)]
    spark.createDataFrame(rows + rows[:40], "doc_id long, text string, lang string").coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    query, own = catalogue.QUERIES["store_sync"](spark, str(tmp_path)), duckdb.connect()
    own.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = own.sql(catalogue.ORACLE_SQL["store_sync"])
    assert sorted(map(tuple, query.select(*want.columns).collect())) == sorted(want.fetchall())
