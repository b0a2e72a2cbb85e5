"""Session settings the operators are planned for. They change speed, never results."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Runtime re-planning: hot join partitions are split, small shuffles merged, lookups broadcast by real size.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Typing and rules make methods the JVM refuses to compile (over 8000 bytes of byte code); with this
    # limit Spark generates them in smaller pieces instead of running them interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # No stack walk per column expression while a plan is put together.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Load dates and parsed dates must not depend on where the driver runs.
    "spark.sql.session.timeZone": "UTC",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder
