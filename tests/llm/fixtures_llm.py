"""Fixtures of these tests: tables of rows, written as Parquet, and a query's SQL over them.

Test modules import them by name, so that no second ``conftest`` hides the first."""

import math

import pytest

SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "pages": "page_id long, url string, html string",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
}


def value(v):
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def multiset(rows):
    return sorted((tuple(value(v) for v in r) for r in rows), key=repr)


@pytest.fixture
def tables(spark, tmp_path):
    """Writes ``name=rows`` (tuples in the table's columns) and returns the folder."""
    def write(**given):
        for name, rows in given.items():
            spark.createDataFrame(rows, SCHEMAS[name]).coalesce(2).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return write


@pytest.fixture
def agrees(spark):
    """A query gives the rows of its SQL on DuckDB; returns Spark's rows."""
    def compare(key, folder, *names):
        import duckdb

        from candlewick.llm.queries import ORACLES, QUERIES
        con = duckdb.connect()
        for name in names:
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet/*.parquet')")
        got = QUERIES[key](spark, folder)
        rows = got.collect()
        want = con.execute(ORACLES[key]).df()
        assert sorted(got.columns) == sorted(want.columns)
        cols = sorted(got.columns)
        plain = want[cols].astype(object).where(want[cols].notna(), None)
        assert multiset([tuple(r[c] for c in cols) for r in rows]) == multiset(plain.itertuples(index=False, name=None))
        return rows
    return compare
