"""Run the queries and their SQL side by side: python -m checks.compare [sf_dir] [names...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import DataFrame

TABLES = """region nation customer supplier part orders lineitem events documents embeddings
    pages benchmark labels conversations""".split()
KINDS = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
         "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set threads = 8")
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    def plain(v):
        if pd.isna(v):
            return ""
        if isinstance(v, float):  # whole numbers turn into floats where some are missing
            return str(int(v)) if v.is_integer() else repr(v)
        return str(v)

    pdf = pdf[sorted(pdf.columns)].astype(object)
    return sorted(tuple(map(plain, r)) for r in pdf.itertuples(index=False))


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a Spark result and the SQL's: names, types, rows."""
    rel = con.sql(sql)
    theirs = dict(zip(rel.columns, map(str, rel.types)))
    ours = {c: KINDS.get(t, t) for c, t in df.dtypes}
    found = []
    if ours != theirs:
        found.append(f"schema {sorted(set(ours.items()) ^ set(theirs.items()))}")
    a, b = _rows(df.toPandas()), _rows(rel.df())
    if len(a) != len(b):
        found.append(f"rows {len(a)} against {len(b)}")
    elif a != b:
        wrong = [(x, y) for x, y in zip(a, b) if x != y]
        found.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    return found


if __name__ == "__main__":
    from clickloom.session import start

    from .oracle import ORACLE
    from .queries import all_queries

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = start("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8",
                                            "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name, query in all_queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        begun = time.time()
        try:
            if name in ORACLE:
                wrong = differences(query(spark, sf), con, ORACLE[name])
            else:
                n = query(spark, sf).count()
                wrong = [] if n else ["no rows"]
        except Exception as e:  # report and go on with the other queries
            wrong = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(wrong)
        mark = "ok" if not wrong else "DIFFERS " + "; ".join(wrong)
        kind = "" if name in ORACLE else " (rows only)"
        print(f"{name:24s} {time.time() - begun:6.2f}s{kind} {mark}", flush=True)
    print(f"{bad} of {len(all_queries())} differ")
    sys.exit(bool(bad))
