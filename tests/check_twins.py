"""Run registered queries next to their SQL twins in DuckDB.

`python tests/check_twins.py [scale factor or folder] [query name...]`
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return sorted(picked, key=lambda r: tuple((v is not None, str(v)) for v in r))


def same(a, b) -> bool:
    return a == b and (a is None or isinstance(a, type(b)) or isinstance(b, type(a)))


def difference(df, con, sql: str) -> str | None:
    """None if the Spark frame and the SQL give the same rows, else what differs."""
    got = rows_of(df.columns, df.collect())
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {df.columns} vs {names}"
    want = rows_of(names, found.fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    for g, w in zip(got, want):
        if not all(same(x, y) for x, y in zip(g, w)):
            return f"{sorted(names)}: {g} vs {w}"
    return None if got else "no rows"


def main() -> int:
    import __spark_entry__ as entry
    from tagloom import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = sf if "/" in sf else f"/root/testdata/sf{sf}"
    spark = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = duck(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in sql:
                result = difference(df, con, sql[name]) or f"equal ({df.count()} rows)"
            else:
                result = f"rows only ({len(df.collect())})"
        except Exception as error:  # noqa: BLE001
            result = f"ERROR {str(error)[:600]}"
        bad += not result.startswith(("equal", "rows only"))
        print(f"{name:22s} {time.time() - start:6.2f}s {result}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 1))
