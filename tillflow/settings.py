"""Session settings the plans count on."""

from pyspark.sql import SparkSession

# Adaptive execution splits a join partition that one key has blown up.  By
# default it keeps its hands off when the next aggregation would have used the
# join's partitioning, as after a join by product and a grouping by product; the
# extra shuffle it then takes carries pre-aggregated rows only.
# One time zone decides to which day an instant belongs, whichever machine submits.
# Shuffle files go when the query that wrote them ends; by default they stay until the
# driver happens to collect its garbage, so a plan of many writes holds those of all of them.
# Whoever runs one and the same DataFrame twice has Spark make them again.
# Stored tables are packed closer than by default.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
