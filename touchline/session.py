"""Session settings the plans are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings; none of them changes a result.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot matches are split at run time even where that costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Frames are many and small, so hash aggregation with object state pays for more keys than the default of 128;
    # a thousand frames of a few hundred rows are some tens of megabytes in a task.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "1024",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RECOMMENDED_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "touchline", cores: str = "8", memory: str = "8g") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
