"""Run registered queries beside their SQL: python tests/oracle.py DIR [NAME...]"""

import math
import sys
import time
from pathlib import Path


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(x):
        if isinstance(x, float):
            return None if math.isnan(x) else float(f"{x:.9g}") + 0.0
        return x

    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, sf_dir, name, run, sql):
    import duckdb

    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    frame = run(spark, sf_dir)
    ours = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    done = con.execute(sql)
    columns = [d[0] for d in done.description]
    theirs = rows_of(columns, done.fetchall())
    kinds = dict(zip(columns, [str(d[1]) for d in done.description], strict=True))
    assert sorted(frame.columns) == sorted(columns), (name, frame.columns, columns)
    assert len(ours) == len(theirs), (name, len(ours), len(theirs))
    bad = [(a, b) for a, b in zip(ours, theirs, strict=True) if a != b]
    assert not bad, (name, len(bad), bad[:2])
    return frame.dtypes, kinds


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).parent.parent))
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "6g").getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    sql = e.oracle_sql()
    for name, run in e.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:] or not sys.argv[2:] and (name.startswith("op") or name == "pipeline"):
            continue
        began = time.time()
        try:
            said = compare(spark, sys.argv[1], name, run, sql[name]) if name in sql else run(spark, sys.argv[1]).count()
            print("ok", name, f"{time.time() - began:.1f}", said if name not in sql else "")
        except Exception as error:
            print("BAD", name, str(error)[:700].replace("\n", " | "))
