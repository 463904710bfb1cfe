"""Run registered queries and their SQL twins on the same tables and compare the rows."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings"
          " pages benchmark labels conversations").split()

SAME_TYPE = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


def difference(spark, con, sf: str, query, sql: str) -> str | None:
    """What differs between the query and its twin, None when nothing does."""
    df = query(spark, sf)
    names = sorted(df.columns)
    mine = _sorted(tuple(r[n] for n in names) for r in df.collect())
    cursor = con.execute(sql)
    twin_types = {d[0]: str(d[1]) for d in cursor.description}
    order = [d[0] for d in cursor.description]
    if sorted(order) != names:
        return f"columns {names} against {sorted(order)}"
    twin = _sorted(tuple(r[order.index(n)] for n in names) for r in cursor.fetchall())
    types = {n: (t, twin_types[n]) for n, t in df.dtypes if SAME_TYPE.get(t) != twin_types[n]}
    if types:
        return f"types {types}"
    if len(mine) != len(twin):
        return f"{len(mine)} rows against {len(twin)}"
    for a, b in zip(mine, twin):
        if a != b:
            return f"{names}: {a} against {b}"
    return None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from crawlfold.session import local_session

    sf = sys.argv[1]
    chosen = sys.argv[2:] or list(queries())
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name in chosen:
        start = time.time()
        try:
            found = difference(spark, con, sf, queries()[name], oracle_sql()[name])
        except Exception as e:  # a broken query is a finding as well
            found = f"{type(e).__name__}: {str(e)[:400]}"
        bad += found is not None
        print(f"{name:26s} {time.time() - start:6.2f}s {'ok' if found is None else 'DIFF ' + found}", flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} agree")


if __name__ == "__main__":
    main()
