"""Every query with SQL against DuckDB on the smallest tables; the others must run."""

import os
import re

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry


def rows(df, columns):
    def plain(x):
        if hasattr(x, "tolist") and getattr(x, "shape", ()):
            return [plain(y) for y in x]
        if isinstance(x, list):
            return [plain(y) for y in x]
        if pd.isna(x):
            return None
        if isinstance(x, float):
            return int(x) if x == int(x) else round(x, 9)
        return x.item() if hasattr(x, "item") else x

    return sorted(repr(tuple(map(plain, r))) for r in df[columns].astype(object).itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    for f in os.listdir(folder):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{folder}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if not re.match(r"p\d_", n)))
def test_query(spark, folder, duck, name):
    got = entry.queries()[name](spark, folder).toPandas()
    if sql := entry.oracle_sql().get(name):
        want = duck.execute(sql).fetch_df()
        columns = sorted(want.columns)
        assert sorted(got.columns) == columns
        assert rows(got, columns) == rows(want, columns)


def test_entry(spark):
    assert entry.entry(spark).columns == ["a", "b", "a_in_b", "b_in_a", "lines_a", "lines_b"]


def test_nothing_else_imports_the_llm_folder():
    root = os.path.dirname(entry.__file__)
    for at, _, files in os.walk(os.path.join(root, "quillspark")):
        if os.path.basename(at) != "llm":
            for f in files:
                if f.endswith(".py"):
                    assert "quillspark.llm" not in open(os.path.join(at, f), encoding="utf-8").read(), f
