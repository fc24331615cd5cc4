"""Runs from a topic to a report: lazy stages, written where a stage's result is used more than once.

Modes: `full` (taxonomy, collection, annotation, then as `workflow`), `workflow` (summary, training, evaluation, report)
and `minimal_agentic` (the same with decisions, search over settings and retries).
"""

from __future__ import annotations

import os
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import order
from tessera.operators import annotate, collect, dataset, evaluate, html, metrics, sft, taxonomy
from tessera.plans import registry, report
from tessera.plans.decisions import Decider, FixedDecisions
from tessera.sources import connectors, http, readers, writers
from tessera.sources.config import PipelineConfig, TrainConfig


class Pipeline:
    def __init__(self, spark: SparkSession, config: PipelineConfig | dict | None = None, *, annotator=None, decider=None, search=None, scrape=None, pages=None, pictures=None, generator=None, trainer=None, hub=None, reg=None, **overrides):
        """Connectors that are not given come from the settings: an API key means the service, none the offline stand-in."""
        if isinstance(config, PipelineConfig) and not overrides:
            self.cfg = config
        else:
            base = config if isinstance(config, dict) else vars(config) if config else None
            self.cfg = PipelineConfig.from_env(**overrides) if base is None else PipelineConfig.build(**(dict(base) | overrides))
        self.spark = spark
        c = self.cfg
        live = http.annotator(c.llm_provider, c.llm_model, c.llm_api_key, c.llm_temperature) if c.llm_api_key else None
        self.annotator, self.decisions = annotator or live or connectors.FixedAnnotator(), decider or live or FixedDecisions()
        self.search = search or (http.Search(c.serper_api_key) if c.serper_api_key else connectors.FixedSearch())
        self.scrape = scrape or (http.Scrape(c.serper_api_key) if c.serper_api_key else connectors.FixedScrape())
        self.pages = pages or (http.Pages() if c.serper_api_key else connectors.FixedPages())
        self.pictures = pictures or (http.Pictures() if c.serper_api_key else connectors.FixedPictures())
        self.registry = reg or registry.default_registry()
        self.generator, self.trainer, self.hub = generator, trainer, hub
        #: How annotators are asked.
        self.pace = {"batch_size": c.llm_batch_size, "delay": c.llm_batch_delay}

    def path(self, *parts: str) -> str:
        return os.path.join(self.cfg.run_dir, *parts)

    def run(self) -> dict:
        modes = {"full": self.full, "workflow": self.workflow, "minimal_agentic": self.agentic, "agentic": self.agentic}
        if self.cfg.mode not in modes:
            raise ValueError(f"unknown mode {self.cfg.mode!r}")
        return modes[self.cfg.mode]()

    def _held(self, df: DataFrame, *parts: str) -> DataFrame:
        """Written once and read back, so that a connector is asked once."""
        return self.spark.read.schema(df.schema).parquet(writers.parquet(df, self.path(*parts)))

    # Stages of the full mode

    def queries(self) -> DataFrame:
        country = self.cfg.country
        cats = self._held(taxonomy.categories(self.spark, country, self.annotator, **self.pace), "taxonomy", "categories")
        subs = self._held(taxonomy.subcategories(cats, country, self.annotator, **self.pace), "taxonomy", "subcategories")
        found = self._held(taxonomy.queries(subs, country, self.annotator, **self.pace), "taxonomy", "queries")
        return taxonomy.flattened(taxonomy.required(found), self.cfg.max_queries)

    def texts(self, queries: DataFrame) -> DataFrame:
        """(ord, text): searched, filtered and cut before anything is scraped, then unique texts."""
        cfg = self.cfg
        placed = order.ordinal(queries, "cat_ord", "sub_ord", "q_ord", name="place").drop("q_ord").withColumnRenamed("place", "q_ord")
        asked = self._held(collect.distinct_queries(placed), "collect", "asked")
        hits = self._held(collect.searched(asked.withColumn("query", collect.search_query("query")), self.search, cfg.serper_results_per_query, cfg.serper_concurrency), "collect", "hits")
        best = collect.first_hits(hits, cfg.serper_top_results)
        pages = self._held(collect.scraped(best, self.scrape, cfg.serper_concurrency), "collect", "pages")
        writers.jsonl(pages.select("query", "url", F.col("snippet").alias("google_snippet"), "full_text"), self.path("collect", "serper_raw.json"))
        places = asked.select(collect.search_query("query").alias("query"), "q_ord")
        rows = pages.join(places, "query").select((F.col("q_ord") * 1_000_000 + F.col("rank")).alias("ord"), F.col("full_text").alias("text"))
        unique = collect.capped(collect.unique_rows(rows), cfg.size, "ord")
        made = self._held(collect.or_placeholder(unique.orderBy("ord")), "collect", "dataset")
        self._collected(num_samples=made.count(), data_path=self.path("collect", "dataset"), raw_result_path=self.path("collect", "serper_raw.json"), provider="serper", run_dir=cfg.run_dir, collected_at=datetime.now(timezone.utc).isoformat())
        return made

    def _collected(self, **facts) -> None:
        """What is known about the collection, in collect/metadata.json."""
        self.collection = {**getattr(self, "collection", {}), **facts}
        writers.document(self.path("collect", "metadata.json"), self.collection)

    def examples(self, texts: DataFrame) -> tuple[DataFrame, dict]:
        lines = order.ordinal(texts, "ord", name="line_no") if "ord" in texts.columns else order.numbered(texts, "line_no")
        items = self._held(lines.select(F.concat(F.lit("line_"), F.col("line_no").cast("string")).alias("item_id"), "text"), "sft", "items")
        cfg = self.cfg
        if cfg.sft_mode not in ("text", "image"):
            raise ValueError(f"unknown annotation mode {cfg.sft_mode!r}")
        if cfg.sft_mode == "image":
            raise ValueError("the full mode annotates collected texts; annotate pictures with examples_of_images")
        notes = self._held(annotate.annotate_texts(items, self.annotator, cfg.sft_target_language, **self.pace), "sft", "annotations")
        made = self._held(sft.text_sft(notes), "sft", "examples")
        writers.jsonl(made.select("messages"), self.path("sft", "sft.jsonl"))
        return made, annotate.stats(items, notes, made)

    def examples_of_images(self, folder: str) -> DataFrame:
        items = readers.images(self.spark, folder)
        notes = self._held(annotate.annotate_images(items, self.annotator, self.cfg.sft_target_language, **self.pace), "sft", "image_annotations")
        return sft.image_sft(notes, items)

    def images(self) -> DataFrame:
        """(url, img_url, context_text_before, context_text_after, file_path) of the pictures on the collected pages that
        the settings for images allow; each different picture is fetched and written once."""
        c = self.cfg
        pages = self.spark.read.parquet(self.path("collect", "pages"))
        addresses = collect.image_urls(pages).select(F.monotonically_increasing_id().alias("page_id"), "url")
        found = html.images(collect.fetched(addresses, self.pages, c.serper_concurrency), c.image_context_size, c.image_min_width, c.image_min_height)
        found = found.withColumn("address", html.resolved("img_url", "url")).withColumn("name", html.file_name("address"))
        found = self._held(found, "collect", "found_images")
        wanted = found.groupBy("name").agg(F.min("address").alias("url"))
        got = self._held(collect.pictures(wanted, self.pictures, os.path.abspath(self.path("collect", "images")), c.image_min_width, c.image_min_height, c.serper_concurrency), "collect", "pictures")
        names = {"url": "url", "img_url": "img_url", "context_before": "context_text_before", "context_after": "context_text_after", "path": "file_path"}
        return found.join(got, "name").select(*(F.col(a).alias(b) for a, b in names.items()))

    # Training and evaluation

    def _load(self, data_path: str) -> tuple[DataFrame, dict]:
        df, resolved = self.registry.dataset_loaders["hf_text_default"](self.spark, data_path)
        summary = dataset.summary(df, data_path, resolved)
        writers.manifest(self.cfg.run_dir, summary)
        return df, summary

    def _train(self, df: DataFrame, config: TrainConfig, folder: str, i: int, trainer) -> dict:
        """One training: its log written, read back and folded into metrics."""
        os.makedirs(folder, exist_ok=True)
        log = os.path.join(folder, f"metrics_{i}.jsonl")
        if os.path.exists(log):
            os.remove(log)
        rows = dataset.head(df.withColumn("_ord", F.monotonically_increasing_id()), self.cfg.max_samples, "_ord").drop("_ord")
        writers.log_metrics(log, trainer.train(rows, config, folder))
        found = metrics.summary(readers.metrics_log(self.spark, log)).first().asDict()
        record = {"iter_idx": i, "config": config.as_dict(), "metrics": found, "adapter_path": os.path.join(folder, f"adapter_{i}"), "log_paths": {"train_log": log, "metrics": log}}
        writers.append_iteration(os.path.join(folder, "iterations.json"), record)
        return record

    def _tail(self, log: str) -> str:
        lines = metrics.tail(readers.numbered_lines(self.spark, log))
        return "\n".join(r["value"] for r in lines.collect())

    def _judged_rows(self, df: DataFrame, data_path: str) -> DataFrame:
        """The rows to evaluate on: those trained on, or another split of the same data set."""
        return df if self.cfg.eval_split == "train" else readers.dataset(self.spark, data_path, self.cfg.eval_split)[0]

    def evaluation(self, df: DataFrame, model_loader: str | None = None) -> dict:
        """Predictions, failures and the preview of their clusters."""
        cfg = self.cfg
        generator = self.generator or self.registry.model_loaders[model_loader or cfg.model_loader_key]()
        rows = order.numbered(df, "ord", first=0)
        if "messages" in df.columns:
            pair = dataset.input_output(F.col("messages"))
            rows = rows.select("ord", pair["prompt"].alias("prompt"), pair["reference"].alias("reference"))
        else:
            rows = rows.select("ord", dataset.formatted(rows.drop("ord")).alias("prompt"), F.lit(None).cast(T.StringType()).alias("reference"))
        made = self._held(evaluate.predicted(rows, generator, cfg.eval_max_samples, cfg.eval_max_new_tokens), "eval", "predictions")
        failed = self._held(evaluate.failures(made), "eval", "failures")
        writers.jsonl(made, self.path("eval", "predictions.jsonl"))
        writers.jsonl(failed, self.path("eval", "failures.jsonl"))
        clusters = {"clusters": []}
        n = failed.count()
        if n:
            shown = evaluate.preview(evaluate.failure_clusters(failed))
            clusters = {"clusters": [{"cluster": r["cluster"], "count": r["count"], "examples": [e.asDict() for e in r["examples"]]} for r in shown.collect()]}
        writers.document(self.path("eval", "cluster_preview.json"), clusters)
        return {"predictions_path": self.path("eval", "predictions.jsonl"), "failures_path": self.path("eval", "failures.jsonl"), "cluster_preview": clusters, "total_failures": n}

    def _published(self, data_path: str, adapter_path: str) -> dict:
        """Ids of what was pushed: the data set and the adapter, each if a hub and a name for it are set; a failing push is
        told and does not end the run."""
        cfg, ids = self.cfg, {}
        for kind, path, repo in (("dataset", data_path, cfg.hf_dataset_repo), ("adapter", adapter_path, cfg.hf_adapter_repo)):
            if self.hub is not None and repo:
                name = f"{cfg.hf_username}/{repo}" if cfg.hf_username and "/" not in repo else repo
                try:
                    ids[f"{kind}_repo_id"] = self.hub.push(path, name, kind, cfg.hf_token)
                except Exception as e:
                    ids[f"{kind}_error"] = str(e)
        return ids

    def _finish(self, mode: str, summary: dict, chosen: dict, iterations: list[dict], judged: dict, analysis: dict, data_path: str) -> dict:
        path = report.render(self.cfg.run_dir, summary, chosen, iterations, judged["cluster_preview"], analysis)
        out = {"mode": mode, "run_dir": self.cfg.run_dir, "adapter_path": iterations[-1]["adapter_path"], **{k: judged[k] for k in ("predictions_path", "failures_path", "cluster_preview")}, "report_path": path}
        pushed = self._published(data_path, out["adapter_path"])
        return out | ({"hub": pushed} if pushed else {})

    def _trained_and_judged(self, data_path: str, mode: str, extra: dict) -> dict:
        cfg = self.cfg
        df, summary = self._load(data_path)
        trainer = self.trainer or self.registry.trainers[cfg.trainer_key]()
        iterations = [self._train(df, cfg.train_config(), cfg.run_dir, i, trainer) for i in range(cfg.max_iters)]
        if not iterations:
            raise RuntimeError("training made no adapter")
        chosen = {"dataset_loader_key": "hf_text_default", "model_loader_key": cfg.model_loader_key, "lora_preset_key": cfg.lora_preset_key, "trainer_key": cfg.trainer_key, "hf_model_id": cfg.hf_model_id, "primary_metric": "eval_loss", "rationale": f"{mode} mode"}
        return self._finish(mode, summary, chosen, iterations, self.evaluation(self._judged_rows(df, data_path)), extra, data_path) | extra

    def full(self) -> dict:
        texts = self.texts(self.queries())
        if self.cfg.collect_images:
            index = writers.jsonl(self.images(), self.path("collect", "images.json"))
            kept = self.spark.read.schema("file_path string").json(index).count()
            self._collected(images_dir=self.path("collect", "images"), images_index=index, num_images=kept)
        made, counts = self.examples(texts)
        data = writers.parquet(made.select("messages"), self.path("sft", "data.parquet"))
        return self._trained_and_judged(data, "full", {"sft": counts})

    def workflow(self) -> dict:
        if not self.cfg.data_path:
            raise ValueError("the workflow mode needs data_path")
        return self._trained_and_judged(self.cfg.data_path, "workflow", {})

    def agentic(self) -> dict:
        cfg = self.cfg
        if not cfg.data_path:
            raise ValueError("the agentic mode needs data_path")
        df, summary = self._load(cfg.data_path)
        ask = Decider(self.decisions, cfg.run_dir, self.registry.snapshot())
        chosen = ask.components(summary, ask.modality(summary)["modality"]) | {"hf_model_id": cfg.hf_model_id}
        trainer, bounds, config = self.trainer or self.registry.trainers[chosen["trainer_key"]](), metrics.Bounds(), cfg.train_config()
        if cfg.search_trials > 0:
            config = self.searched(df, config, bounds, trainer)
        iterations, preset = [], chosen["lora_preset_key"]
        for i in range(cfg.max_iters):
            iterations.append(self._train(df, config, cfg.run_dir, i, trainer) | {"lora_preset_key": preset})
            decision = ask.adjustments(iterations[-1]["metrics"], self._tail(iterations[-1]["log_paths"]["train_log"]), bounds.as_dict())
            if not decision["should_retry"]:
                break
            preset = decision["switch_lora_preset_key"] or preset
            config = metrics.adjusted(config, decision, bounds)
        if not iterations:
            raise RuntimeError("training made no adapter")
        judged = self.evaluation(self._judged_rows(df, cfg.data_path), chosen["model_loader_key"])
        analysis = ask.errors({"failures_path": judged["failures_path"], "total_failures": judged["total_failures"]}, judged["cluster_preview"])
        return self._finish("minimal_agentic", summary, chosen, iterations, judged, analysis, cfg.data_path) | {"component_selection": chosen, "error_analysis": analysis}

    def searched(self, df: DataFrame, config: TrainConfig, bounds: metrics.Bounds, trainer) -> TrainConfig:
        """The best of random settings; the given ones where no trial has a score."""
        tried = metrics.candidates(config, bounds, self.cfg.search_trials, self.cfg.seed)
        rows = [(i, (m := self._train(df, c, self.path("search", f"trial_{i}"), 0, trainer)["metrics"])["best_eval_loss"], m["last_train_loss"]) for i, c in enumerate(tried)]
        best = metrics.best_trial(self.spark.createDataFrame(rows, "trial int, best_eval_loss double, last_train_loss double")).first()
        return tried[best["trial"]] if best else config

