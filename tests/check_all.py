"""Compare every query with its SQL: python tests/check_all.py [folder] [name ...]"""

from __future__ import annotations

import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession

from __spark_entry__ import oracle_sql, queries
from tests.compare import connect, differences


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in sql:
                notes = differences(df, con, sql[name])
            else:
                notes = [] if df.count() else ["no rows"]
        except Exception as error:  # report every query, whatever happens to one
            notes = [f"{type(error).__name__}: {str(error)[:600]}"]
        kind = "sql" if name in sql else "rows"
        print(f"{'FAIL' if notes else 'ok  '} {name} ({kind}) {time.time() - start:.1f}s", flush=True)
        for note in notes:
            print("     ", note)
        bad += bool(notes)
    print(f"{bad} of {len(names) or len(queries())} differ; without query: {set(sql) - set(queries())}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
