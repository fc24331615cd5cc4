"""Extension: metrics of a growing training log, folded while it is written.

The batch operators have no stream behind them; this runs the same fold over an append-only folder of JSON lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

SCHEMA = "run string, line_no long, step int, loss double, train_loss double, eval_loss double"


def log_stream(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(SCHEMA).json(folder)


def folded(log: DataFrame) -> DataFrame:
    """Metrics of each run; the state is one row a run, whatever the log's length, and repeated rows change nothing."""
    train = F.coalesce("loss", "train_loss")
    last = lambda c: F.max_by(c, F.when(c.isNotNull(), F.col("line_no")))
    return log.groupBy("run").agg(F.greatest(F.coalesce(F.max("step"), F.lit(0)), F.lit(0)).alias("steps"), F.min("eval_loss").alias("best_eval_loss"), last(train).alias("last_train_loss"), last(F.col("eval_loss")).alias("last_eval_loss"))


def start(spark: SparkSession, folder: str, checkpoint: str, name: str) -> StreamingQuery:
    """Run the fold over what has arrived, into an in-memory table called `name`."""
    return folded(log_stream(spark, folder)).writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
