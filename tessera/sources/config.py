"""Settings of a run, from the environment and overrides."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import asdict, dataclass, fields, replace


@dataclass(frozen=True)
class TrainConfig:
    # Names and defaults of the training settings.
    lr: float = 2e-4
    batch_size: int = 4
    grad_accum: int = 4
    max_steps: int = 200
    warmup_ratio: float = 0.03
    weight_decay: float = 0.0
    max_seq_len: int = 512
    eval_steps: int = 50
    seed: int = 42

    def changed(self, **values) -> TrainConfig:
        return replace(self, **values)

    def as_dict(self) -> dict:
        return asdict(self)


@dataclass(frozen=True)
class PipelineConfig:
    # Names and defaults of the settings of a run.
    country: str
    sft_target_language: str
    hf_model_id: str
    mode: str = "full"
    run_dir: str = "run"
    llm_provider: str = "gemini"
    llm_model: str = "gemini-2.5-flash"
    llm_api_key: str = ""
    llm_temperature: float = 0.2
    llm_batch_size: int = 5
    llm_batch_delay: float = 1.5
    serper_api_key: str = ""
    serper_results_per_query: int = 10
    serper_top_results: int = 5
    serper_concurrency: int = 50
    max_queries: int | None = None
    collect_images: bool = False
    image_min_width: int = 300
    image_min_height: int = 300
    image_context_size: int = 500
    sft_mode: str = "text"
    trainer_key: str = "static_sft_default"
    lora_preset_key: str = "lora_attn_small"
    model_loader_key: str = "hf_causal_lm_default"
    max_iters: int = 1
    max_steps: int = 200
    seed: int = 42
    train_lr: float = 2e-4
    train_batch_size: int = 4
    train_grad_accum: int = 4
    train_warmup_ratio: float = 0.03
    train_weight_decay: float = 0.0
    train_max_seq_len: int = 512
    train_eval_steps: int = 50
    max_samples: int | None = None
    search_trials: int = 0
    eval_split: str = "train"
    eval_max_samples: int = 64
    eval_max_new_tokens: int = 128
    hf_token: str = ""
    hf_username: str = ""
    hf_dataset_repo: str = ""
    hf_adapter_repo: str = ""
    data_path: str | None = None
    size: int | None = None

    @classmethod
    def build(cls, **values) -> PipelineConfig:
        """Known names only; text is read as the field's type."""
        kinds = {f.name: str(f.type) for f in fields(cls)}
        if unknown := sorted(set(values) - set(kinds)):
            raise ValueError(f"unknown settings: {', '.join(unknown)}")
        if missing := [n for n in ("country", "sft_target_language", "hf_model_id") if n not in values]:
            raise ValueError(f"required settings are missing: {', '.join(missing)}")
        return cls(**{k: _read(v, kinds[k], k) for k, v in values.items()})

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None, **overrides) -> PipelineConfig:
        """Non-empty environment values under the overrides."""
        env = os.environ if env is None else env
        found = {name: env.get(name.upper(), "") for name in FROM_ENV}
        found["llm_api_key"] = env.get("LLM_API_KEY") or env.get("OPENAI_API_KEY") or ""
        return cls.build(**({k: v for k, v in found.items() if v} | overrides))

    def train_config(self) -> TrainConfig:
        return TrainConfig(self.train_lr, self.train_batch_size, self.train_grad_accum, self.max_steps, self.train_warmup_ratio, self.train_weight_decay, self.train_max_seq_len, self.train_eval_steps, self.seed)


# Settings that the environment may give, under their upper-case names.
FROM_ENV = (
    "country", "run_dir", "llm_provider", "llm_model", "llm_temperature", "serper_api_key", "serper_results_per_query",
    "serper_top_results", "max_queries", "collect_images", "image_min_width", "image_min_height", "image_context_size",
    "sft_target_language", "hf_model_id", "max_iters", "max_steps", "max_samples", "train_batch_size", "train_max_seq_len",
    "eval_max_samples", "hf_username", "hf_token", "hf_dataset_repo", "hf_adapter_repo",
)


def _read(v, kind: str, name: str):
    if v is None or not isinstance(v, str):
        return v
    base = kind.replace(" | None", "")
    try:
        if base == "bool":
            return {"1": True, "true": True, "yes": True, "on": True, "0": False, "false": False, "no": False, "off": False}[v.lower()]
        return {"int": int, "float": float}.get(base, str)(v)
    except (KeyError, ValueError):
        raise ValueError(f"{name}: cannot read {v!r} as {base}") from None
