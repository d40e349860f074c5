"""Session settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution sizes shuffle partitions, splits skewed join partitions and
# picks broadcasts from measured sizes. Values given to spark-submit win.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Entities with dozens of columns make generated methods above 8000 bytes, which
    # the JVM only interprets. With this limit Spark generates small methods for
    # ones lose a little.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Compressed rows get far wider when they are cleaned, and dedup sorts them before the
    # shuffle. 128 MB of lines, Spark's default, are ten million rows, which a task spills.
    "spark.sql.files.maxPartitionBytes": "16m",
}


def small_methods(spark: SparkSession) -> None:
    """Let a session that someone else made compile wide plans, unless it says otherwise."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, DEFAULTS[key])


def small_scans(spark: SparkSession) -> None:
    """Let such a session sort wide rows in memory, unless it names a size of its own."""
    key = "spark.sql.files.maxPartitionBytes"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, DEFAULTS[key])


def session(app_name: str, hive: bool = False, **extra: str) -> SparkSession:
    """Get or create a session with the defaults that the submitter left open."""
    builder = SparkSession.builder.appName(app_name)
    if hive:
        builder = builder.enableHiveSupport()
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    submitted = spark.sparkContext.getConf()
    for key, value in DEFAULTS.items():
        if not submitted.contains(key) and key not in extra:
            spark.conf.set(key, value)
    return spark
