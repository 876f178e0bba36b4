"""``spark-submit`` target: load CSV files and rebuild Silver and Gold."""

import argparse

from pyspark.sql import SparkSession

from tillflow.plans.medallion import run
from tillflow.settings import configure
from tillflow.sources.lake import Lake

parser = argparse.ArgumentParser(prog="tillflow", description=__doc__)
parser.add_argument("source", help="CSV file or folder")
parser.add_argument("--base", required=True, help="folder of the layers, on shared storage")
parser.add_argument("--format", default="parquet", choices=["parquet", "delta"])
parser.add_argument("--since", help="merge only the loads of this run date and later")
arguments = parser.parse_args()

session = configure(SparkSession.builder.appName("tillflow").getOrCreate())
load = run(session, Lake(arguments.base, arguments.format), arguments.source, arguments.since)
print(f"{load.row_count} rows loaded; files left out: {load.rejected_files or 'none'}")
