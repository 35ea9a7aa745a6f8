"""Runs registered queries on Spark and their SQL on DuckDB and compares rows as multisets."""

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

SQL_KINDS = {"bigint": "bigint", "int": "integer", "double": "double", "string": "varchar", "boolean": "boolean"}


def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(cell(row[i]) for i in order) for row in rows)


def difference(spark, con, sf_dir, run, sql):
    """None when both agree, else a short text."""
    df = run(spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    kinds = {d[0]: str(d[1]).lower() for d in con.execute(f"describe {sql}").fetchall()}
    for name, kind in df.dtypes:
        if SQL_KINDS[kind] != kinds[name]:
            return f"type of {name}: {kind} against {kinds[name]}"
    if ours != theirs:
        return (
            f"{sum(ours.values())} rows against {sum(theirs.values())}; "
            f"only ours {list(ours - theirs)[:2]}; only theirs {list(theirs - ours)[:2]}"
        )
    return "" if sum(ours.values()) else "no rows"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from courtside.session import build_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "compare", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    oracles = entry.oracle_sql()
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            outcome = difference(spark, con, sf_dir, run, oracles[name]) or "ok"
        except Exception as error:  # report every query
            outcome = f"ERROR {type(error).__name__} {str(error)[:600]}"
        print(f"{name}: {outcome} {time.time() - began:.1f}s", flush=True)
