"""Run registered queries and their SQL side by side and compare names, types, row counts and values."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
STRICT = bool(os.environ.get("STRICT"))  # compare doubles bit by bit
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def duck(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value if STRICT else float(f"{value:.9g}")
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, name: str, fn, sql: str | None, folder: str) -> tuple[str, float, float]:
    begun = time.time()
    df = fn(spark, folder)
    got = df.collect()
    spent = time.time() - begun
    if sql is None:
        return (f"rows only ({len(got)})" if got else "EMPTY"), spent, 0.0
    begun = time.time()
    con = duck(folder)
    cursor = con.execute(sql)
    names = [x[0] for x in cursor.description]
    kinds = {x[0]: str(x[1]) for x in cursor.description}
    want = cursor.fetchall()
    asked = time.time() - begun
    if sorted(names) != sorted(df.columns):
        return f"COLUMNS {sorted(df.columns)} != {sorted(names)}", spent, asked
    types = {f: KINDS.get(t, t) for f, t in df.dtypes}
    odd = {n: (types[n], kinds[n]) for n in names if types[n] != kinds[n]}
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a != b:
        more, less = list((a - b).items())[:3], list((b - a).items())[:3]
        return f"VALUES rows {len(got)}/{len(want)} diff {sum((a - b).values())} spark {more} sql {less}", spent, asked
    return f"ok ({len(got)})" + (f" TYPES {odd}" if odd else "") + ("" if got else " EMPTY"), spent, asked


def session():
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master("local[8]").appName("check").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "16g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
    import __spark_entry__ as e

    folder = f"/root/testdata/sf{sys.argv[1]}"
    wanted = sys.argv[2:]
    spark = session()
    bad = 0
    for name, fn in e.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            said, spent, asked = compare(spark, name, fn, e.oracle_sql().get(name), folder)
        except Exception as err:  # noqa: BLE001 - report every query
            said, spent, asked = f"ERROR {type(err).__name__}: {str(err)[:600]}", 0.0, 0.0
        bad += not said.startswith(("ok", "rows only"))
        print(f"{name:34s} {spent:6.2f}s {asked:6.2f}s  {said}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
