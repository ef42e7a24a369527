"""Queries of labharm.llm against their SQL twins on small tables of one's own."""

import duckdb
import pandas as pd

from labharm.llm import catalog


def cell(v):
    if v is None or pd.isna(v):
        return "null"
    return f"{v:.12g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


def compare(spark, folder, query, **tables):
    """tables: DataFrames by name, written below folder for both engines."""
    db = duckdb.connect()
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    got, want = catalog.QUERIES[query](spark, str(folder)).toPandas(), db.sql(catalog.ORACLE_SQL[query]).df()
    assert sorted(got.columns) == sorted(want.columns)
    rows = [sorted(tuple(cell(v) for v in r) for r in x[sorted(x.columns)].itertuples(index=False)) for x in (got, want)]
    assert rows[0] == rows[1]
    return got
