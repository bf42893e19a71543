"""Run registered queries next to their SQL twins: `python tests/check_queries.py <sf_dir> [name ...]`."""

import os
import sys
import time
import tempfile
import traceback

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
import oracle  # noqa: E402

if __name__ == "__main__":
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-")).getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    con, sqls, bad = oracle.connect(sf_dir), entry.oracle_sql(), 0
    for name, build in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = build(spark, sf_dir)
            found = oracle.difference(df, con, sqls[name]) if name in sqls else f"(no SQL) {df.count()} rows"
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:600]}"
            if names:
                traceback.print_exc()
        bad += found is not None
        print(f"{'ok ' if found is None else 'BAD'} {time.time() - start:6.2f}s {name} {found or ''}", flush=True)
    print(f"{bad} differ")
