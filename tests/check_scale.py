"""Run by hand: every query against its twin at a given folder. python -m tests.check_scale DIR [names]"""

import sys
import time

from pyspark.sql import SparkSession

from __spark_entry__ import oracle_sql, queries
from tests.oracle_check import connect, differences


def main(sf_dir, names):
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, twins, bad = connect(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        started = time.time()
        found = differences(query(spark, sf_dir), con, twins[name])
        bad += bool(found)
        print(name, "ok" if not found else found, round(time.time() - started, 1), flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main(sys.argv[1], set(sys.argv[2:]))
