from pathlib import Path

import duckdb
import pandas as pd
import pytest

from standbyspark import queries

DATA = Path("/root/testdata/sf0.001")


def plain(frame):
    frame = frame[sorted(frame.columns)].astype(object)

    def text(v):
        if v is None or v is pd.NA or (isinstance(v, float) and pd.isna(v)):
            return ""
        return str(v) if isinstance(v, (bool, str)) or not hasattr(v, "__float__") else f"{float(v):.9g}"

    return sorted(tuple(text(v) for v in row) for row in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        db.execute(f"create view {file.stem} as select * from '{file}'")
    ours, theirs = queries.QUERIES[name](spark, str(DATA)).toPandas(), db.execute(queries.ORACLE_SQL[name]).fetchdf()
    assert sorted(ours.columns) == sorted(theirs.columns) and plain(ours) == plain(theirs)


def test_entry_point_works_without_the_corpus_operators(spark):
    import __spark_entry__ as entry

    assert set(queries.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 7
