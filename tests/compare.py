"""Run registered queries in Spark and their SQL in DuckDB, and compare the results.

python tests/compare.py [folder] [query ...]
"""

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def canonical(pdf):
    """Columns by name, rows sorted, every value as comparable text."""
    pdf = pdf[sorted(pdf.columns)]
    out = pd.DataFrame(index=pdf.index)
    for c in pdf.columns:
        col = pdf[c]
        if pd.api.types.is_datetime64_any_dtype(col):
            col = col.astype("datetime64[us]")
        elif col.dtype == object and len(col.dropna()) and hasattr(col.dropna().iloc[0], "isoformat"):
            col = pd.to_datetime(col).astype("datetime64[us]")
        elif pd.api.types.is_numeric_dtype(col):
            col = col.astype("float64")
        out[c] = col.map(lambda v: "~" if pd.isna(v) else str(v))
    return out.sort_values(list(out.columns)).reset_index(drop=True)


# Spark type -> DuckDB type of a result column.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def differences(spark, con, name, build, sql, folder):
    """None when equal, else what differs."""
    got = build(spark, folder)
    relation = con.sql(sql)
    want_types = {c: str(k) for c, k in zip(relation.columns, relation.types, strict=True)}
    got_types = {c: TYPES.get(k, k) for c, k in got.dtypes}
    if got_types != want_types:
        return f"types {got_types} != {want_types}"
    left, right = canonical(got.toPandas()), canonical(relation.df())
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    unequal = (left != right).any(axis=1)
    if unequal.any():
        return f"{unequal.sum()} rows differ:\n{left[unequal].head(3)}\n{right[unequal].head(3)}"
    return None


def main(folder, names):
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sql = entry.oracle_sql()
    bad = []
    for name, build in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            found = differences(spark, con, name, build, sql[name], folder)
        except Exception as e:  # noqa: BLE001
            found = f"{type(e).__name__}: {str(e)[:600]}"
        if found:
            bad.append(name)
        print(f"{'BAD' if found else 'ok '} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    print(f"{len(bad)} bad: {bad}")
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    where = args[0] if args else "/root/testdata/sf0.01"
    sys.exit(bool(main(where, args[1:])))
