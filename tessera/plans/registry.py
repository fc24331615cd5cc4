"""Named components that a run can choose from."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from tessera.sources import readers
from tessera.sources.connectors import CurveTrainer, EchoGenerator

# Adapter presets and the default model.
ATTENTION = ("q_proj", "k_proj", "v_proj", "o_proj", "c_attn", "c_proj")
MLP = ("up_proj", "down_proj", "gate_proj", "c_fc")
LORA_PRESETS = {
    "lora_attn_small": {"r": 8, "alpha": 16, "dropout": 0.05, "target_modules": list(ATTENTION)},
    "lora_attn_medium": {"r": 16, "alpha": 32, "dropout": 0.05, "target_modules": list(ATTENTION)},
    "lora_attn_mlp_small": {"r": 8, "alpha": 16, "dropout": 0.05, "target_modules": list(ATTENTION + MLP)},
}
DEFAULT_MODEL = "Qwen/Qwen2.5-1.5B"


@dataclass(frozen=True)
class Registry:
    dataset_loaders: Mapping[str, Callable]
    model_loaders: Mapping[str, Callable]
    lora_presets: Mapping[str, dict] = field(default_factory=lambda: LORA_PRESETS)
    trainers: Mapping[str, Callable] = field(default_factory=dict)
    default_model: str = DEFAULT_MODEL

    def snapshot(self) -> dict:
        """Sorted keys of everything, for prompts and checks."""
        kinds = {"dataset_loader_keys": self.dataset_loaders, "model_loader_keys": self.model_loaders, "lora_preset_keys": self.lora_presets, "trainer_keys": self.trainers}
        return {k: sorted(v) for k, v in kinds.items()} | {"default_hf_model_id": self.default_model}


def _absent(kind: str) -> Callable:
    def load(*_, **__):
        raise NotImplementedError(f"{kind} models need a loader of your own")

    return load


def default_registry() -> Registry:
    load = readers.dataset
    return Registry(
        dataset_loaders={"hf_text_default": load, "hf_image_default": load, "hf_multimodal_default": load},
        model_loaders={"hf_causal_lm_default": EchoGenerator, "hf_vision_default": _absent("vision"), "hf_multimodal_default": _absent("multimodal")},
        trainers={"static_sft_default": CurveTrainer},
    )
