"""Runs a query and its SQL on the same tables and compares the rows."""

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(_cell(row[name]) for name in names) for row in df.collect())


def sql_rows(con, sql):
    cursor = con.execute(sql)
    columns = [column[0] for column in cursor.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = Counter(tuple(_cell(row[i]) for i in order) for row in cursor.fetchall())
    return [columns[i] for i in order], rows


def difference(df, con, sql):
    """None when equal, else a short account of what differs."""
    ours, theirs = spark_rows(df), sql_rows(con, sql)
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} against {theirs[0]}"
    only_ours, only_theirs = ours[1] - theirs[1], theirs[1] - ours[1]
    if only_ours or only_theirs:
        return (
            f"{sum(ours[1].values())} rows against {sum(theirs[1].values())}; "
            f"only here {list(only_ours.items())[:3]}; only in SQL {list(only_theirs.items())[:3]}"
        )
    return None
