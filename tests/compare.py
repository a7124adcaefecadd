"""Compare a Spark result with DuckDB SQL: names, types, rows as a multiset with exact values."""

from collections import Counter

import duckdb
import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _plain(kind: pa.DataType) -> str:
    if pa.types.is_large_string(kind) or pa.types.is_string(kind):
        return "string"
    return "null" if pa.types.is_null(kind) else str(kind)


def _rows(table: pa.Table, names) -> Counter:
    columns = [table.column(name).to_pylist() for name in names]
    return Counter(zip(*columns, strict=True)) if columns else Counter()


def difference(spark_df, sql, con):
    """An empty list when both results are the same."""
    got, expected = spark_df.toArrow(), con.execute(sql).to_arrow_table()
    if sorted(got.column_names) != sorted(expected.column_names):
        return [f"columns {sorted(got.column_names)} != {sorted(expected.column_names)}"]
    names, problems = sorted(got.column_names), []
    for name in names:
        left, right = _plain(got.schema.field(name).type), _plain(expected.schema.field(name).type)
        if left != right:
            problems.append(f"type of {name}: {left} != {right}")
    if got.num_rows != expected.num_rows:
        problems.append(f"rows {got.num_rows} != {expected.num_rows}")
    left, right = _rows(got, names), _rows(expected, names)
    extra, missing = left - right, right - left
    if extra or missing:
        problems.append(f"{names}\n  only Spark: {list(extra)[:2]}\n  only SQL:   {list(missing)[:2]}")
    return problems
