"""Session settings the jobs rely on."""

from pyspark.sql import SparkSession


def build_session(app_name: str = "millrace", **conf: object) -> SparkSession:
    """A session with UTC timestamps and adaptive execution; `conf` keys use `__` for dots."""
    settings = {
        # Timestamps without a zone are read as UTC, so casts do not move the clock.
        "spark.sql.session.timeZone": "UTC",
        # Coalesces small shuffle partitions and splits skewed join partitions at run time.
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **{key.replace("__", "."): str(value) for key, value in conf.items()},
    }
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
