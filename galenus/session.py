"""One session builder, and readers of the provided tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "galenus", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    base = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.ui.showConsoleProgress": "false"}
    for k, v in {**base, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A provided table. Timestamps without zone become dates where the column is a calendar day."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    for c in ("o_orderdate", "l_shipdate"):
        if c in df.columns:
            df = df.withColumn(c, F.col(c).cast("date"))
    return df
