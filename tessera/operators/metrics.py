"""Training logs folded into metrics, trials compared, settings moved within bounds."""

from __future__ import annotations

import random
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.sources.config import TrainConfig


def summary(log: DataFrame) -> DataFrame:
    """One row (steps, best_eval_loss, last_train_loss, last_eval_loss) of (line_no, step, loss, train_loss, eval_loss).

    Maxima by line are pre-aggregated, so a log of any length folds in one pass.
    """
    train = F.coalesce("loss", "train_loss")
    last = lambda c: F.max_by(c, F.when(c.isNotNull(), F.col("line_no")))
    return log.agg(F.coalesce(F.max("step"), F.lit(0)).alias("steps"), F.min("eval_loss").alias("best_eval_loss"), last(train).alias("last_train_loss"), last(F.col("eval_loss")).alias("last_eval_loss")).withColumn("steps", F.greatest("steps", F.lit(0)))


def tail(lines: DataFrame, n: int = 25, order: str = "line_no") -> DataFrame:
    """The last n lines, in order."""
    return lines.orderBy(F.col(order).desc()).limit(n).orderBy(order)


def score(best_eval_loss: Column, last_train_loss: Column) -> Column:
    """The evaluation loss, else (also where it is exactly 0) the training loss."""
    return F.coalesce(F.when(best_eval_loss != 0, best_eval_loss), last_train_loss)


def best_trial(trials: DataFrame) -> DataFrame:
    """The row of (trial, best_eval_loss, last_train_loss, …) with the least score, the first of equal ones; none if no
    trial has a score."""
    scored = trials.withColumn("score", score(F.col("best_eval_loss"), F.col("last_train_loss"))).where("score is not null")
    return scored.orderBy("score", "trial").limit(1)


@dataclass(frozen=True)
class Bounds:
    # The ranges of the four settings that may move.
    min_lr: float = 1e-5
    max_lr: float = 5e-4
    min_batch_size: int = 1
    max_batch_size: int = 16
    min_grad_accum: int = 1
    max_grad_accum: int = 16
    min_steps: int = 50
    max_steps: int = 1000

    def as_dict(self) -> dict:
        return asdict(self)

    def ranges(self) -> dict[str, tuple]:
        return {"lr": (self.min_lr, self.max_lr), "batch_size": (self.min_batch_size, self.max_batch_size), "grad_accum": (self.min_grad_accum, self.max_grad_accum), "max_steps": (self.min_steps, self.max_steps)}


def candidates(base: TrainConfig, bounds: Bounds, n: int, seed: int) -> list[TrainConfig]:
    """The base settings, then uniform draws within bounds, the same for the same seed."""
    draw, out = random.Random(seed), [base]
    while len(out) < n:
        out.append(base.changed(**{k: draw.uniform(*r) if k == "lr" else draw.randint(*r) for k, r in bounds.ranges().items()}))
    return out


def clamped(value: Column, low, high) -> Column:
    return F.greatest(F.least(value, F.lit(high)), F.lit(low))


def moved(trials: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    """Settings after an adjustment: columns lr, batch_size, grad_accum, max_steps and lr_multiplier, *_delta."""
    change = {"lr": F.col("lr") * F.col("lr_multiplier")} | {k: F.col(k) + F.col(f"{k}_delta") for k in ("batch_size", "grad_accum", "max_steps")}
    return trials.withColumns({k: clamped(c, *bounds.ranges()[k]) for k, c in change.items()})


def adjusted(config: TrainConfig, decision: dict, bounds: Bounds) -> TrainConfig:
    """The same for one set of settings on the driver."""
    wish = {"lr": config.lr * decision["lr_multiplier"]} | {k: getattr(config, k) + decision[f"{k}_delta"] for k in ("batch_size", "grad_accum", "max_steps")}
    return config.changed(**{k: sorted((*bounds.ranges()[k], v))[1] for k, v in wish.items()})
