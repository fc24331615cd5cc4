"""Ordinals over a whole table without gathering it in one task."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held(df: DataFrame) -> DataFrame:
    """The rows, evaluated once and kept in the shared folder.

    Only a session on a single machine that names no folder gets a temporary one; on a cluster that is an error.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and context.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tessera-"))
    return df.checkpoint()


def numbered(df: DataFrame, name: str = "ordinal", first: int = 1) -> DataFrame:
    """All columns and each row's place in the table as it is read; one count a partition reaches the driver."""
    rows = held(df.withColumn(name, F.monotonically_increasing_id()))
    part = F.shiftright(F.col(name), 33)
    sizes = {r["p"]: r["count"] for r in rows.groupBy(part.alias("p")).count().collect()}
    starts, at = [], first
    for p in range(max(sizes, default=-1) + 1):
        starts.append(at)
        at += sizes.get(p, 0)
    start = F.get(F.lit(starts), part.cast("int")) if starts else F.lit(first)
    return rows.withColumn(name, (start + F.col(name).bitwiseAND(F.lit((1 << 33) - 1))).cast("long"))


def ordinal(df: DataFrame, *by: Column | str, name: str = "ordinal", first: int = 1) -> DataFrame:
    """All columns and each row's place in the order `by`.

    Rows are range-sorted once and checkpointed; the sizes of the sorted partitions, one number each, give every
    partition's first place. Ties keep an arbitrary but fixed order.
    """
    return numbered(df.orderBy(*by), name, first)
