"""Command line: python -m tessera.cli --country X --hf_model_id M [--mode full|workflow|minimal_agentic] ..."""

from __future__ import annotations

import argparse
import json

from tessera.plans.pipeline import Pipeline


def settings(argv: list[str] | None = None) -> dict:
    """Overrides by argument; a data path without a mode means the workflow mode."""
    p = argparse.ArgumentParser(prog="tessera")
    for name in ("country", "data_path", "out_dir", "hf_model_id", "sft_target_language"):
        p.add_argument(f"--{name}")
    p.add_argument("--mode", choices=("full", "workflow", "minimal_agentic"))
    for name in ("max_iters", "max_steps", "max_samples", "search_trials"):
        p.add_argument(f"--{name}", type=int)
    p.add_argument("--log-level", default="WARN", dest="log_level")
    found = {k: v for k, v in vars(p.parse_args(argv)).items() if v is not None}
    if "out_dir" in found:
        found["run_dir"] = found.pop("out_dir")
    if "data_path" in found:
        found.setdefault("mode", "workflow")
    return found


def main(argv: list[str] | None = None) -> None:
    from pyspark.sql import SparkSession

    found = settings(argv)
    spark = SparkSession.builder.appName("tessera").getOrCreate()
    spark.sparkContext.setLogLevel(found.pop("log_level"))
    print(json.dumps(Pipeline(spark, **found).run(), indent=2, ensure_ascii=False, default=str))


if __name__ == "__main__":
    main()
