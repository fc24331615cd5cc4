"""The four decisions an annotator takes in an agentic run: strict checks and a log of what was decided."""

from __future__ import annotations

import json
import os

from tessera.functions.jsontext import extract_json
from tessera.sources.connectors import Request, persistent
from tessera.sources.writers import append_line

_TEXTS = "list of str"
# The fields of each decision and their types.
FORMS: dict[str, dict[str, object]] = {
    "decide_modality": {"modality": ("text", "image", "multimodal"), "confidence": float, "rationale": str},
    "select_components": {k: str for k in ("dataset_loader_key", "model_loader_key", "lora_preset_key", "trainer_key", "hf_model_id", "primary_metric", "rationale")},
    "suggest_training_adjustments": {
        "should_retry": bool, "lr_multiplier": float, "batch_size_delta": int, "grad_accum_delta": int, "max_steps_delta": int,
        "switch_lora_preset_key": (str, None), "stop_reason": (str, None), "rationale": str,
    },
    "analyze_errors": {k: _TEXTS for k in ("cluster_labels", "root_causes", "data_fixes", "next_training_actions")},
}


def _fits(v, kind) -> bool:
    if kind == _TEXTS:
        return isinstance(v, list) and all(isinstance(x, str) for x in v)
    if isinstance(kind, tuple):
        return v in kind if str not in kind else v is None or isinstance(v, str)
    if kind is float:
        return isinstance(v, (int, float)) and not isinstance(v, bool)
    return isinstance(v, kind) and (kind is bool or not isinstance(v, bool))


def strict(name: str, payload) -> dict:
    """The payload if it has exactly the decision's fields, each of its type; only integers widen to floats."""
    form = FORMS[name]
    if not isinstance(payload, dict):
        raise ValueError(f"{name}: not an object")
    wrong = sorted({*payload} ^ {*form}) + [k for k in form if k in payload and not _fits(payload[k], form[k])]
    if wrong:
        raise ValueError(f"{name}: wrong fields: {', '.join(wrong)}")
    return {k: float(payload[k]) if kind is float else payload[k] for k, kind in form.items()}


class Decider:
    """Asks the annotator; an answer with unknown registry keys is asked for once more and then taken as it is."""

    def __init__(self, annotator, run_dir: str, snapshot: dict):
        self.annotator, self.snapshot = annotator, snapshot
        self.log = os.path.join(run_dir, "agent_decisions.jsonl")

    def _ask(self, name: str, about: dict, known) -> dict:
        message = f"{name}: answer with one JSON object with the fields {', '.join(FORMS[name])}.\n" + json.dumps(about, indent=2, ensure_ascii=False, default=str)
        ask = lambda m: strict(name, persistent(lambda: extract_json(self.annotator.complete(Request(name, m)))))
        found = ask(message)
        if not known(found):
            found = ask(message + "\nUse only keys of the registry.")
        append_line(self.log, {"stage": name, "payload": found})
        return found

    def modality(self, summary: dict) -> dict:
        return self._ask("decide_modality", {"dataset_summary": summary}, lambda _: True)

    def components(self, summary: dict, modality: str) -> dict:
        kinds = ("dataset_loader_key", "model_loader_key", "lora_preset_key", "trainer_key")
        return self._ask("select_components", {"dataset_summary": summary, "modality": modality, "registry": self.snapshot}, lambda d: all(d[k] in self.snapshot[f"{k}s"] for k in kinds))

    def adjustments(self, metrics: dict, log_tail: str, bounds: dict) -> dict:
        return self._ask("suggest_training_adjustments", {"metrics": metrics, "log_tail": log_tail, "bounds": bounds, "registry": self.snapshot}, lambda d: d["switch_lora_preset_key"] in (None, *self.snapshot["lora_preset_keys"]))

    def errors(self, overview: dict, clusters: dict) -> dict:
        return self._ask("analyze_errors", {"failures": overview, "clusters": clusters}, lambda _: True)


class FixedDecisions:
    """Offline answers: text, the first registry keys, no retry."""

    def __init__(self, retries: int = 0):
        self.retries = retries

    def complete(self, request: Request) -> str:
        answers = {
            "decide_modality": {"modality": "text", "confidence": 0.9, "rationale": "text columns"},
            "select_components": {"dataset_loader_key": "hf_text_default", "model_loader_key": "hf_causal_lm_default", "lora_preset_key": "lora_attn_small", "trainer_key": "static_sft_default", "hf_model_id": "offline", "primary_metric": "eval_loss", "rationale": "defaults"},
            "suggest_training_adjustments": {"should_retry": self.retries > 0, "lr_multiplier": 0.5, "batch_size_delta": 1, "grad_accum_delta": 0, "max_steps_delta": 50, "switch_lora_preset_key": "lora_attn_medium" if self.retries else None, "stop_reason": None, "rationale": "loss"},
            "analyze_errors": {"cluster_labels": ["short"], "root_causes": ["data"], "data_fixes": ["more"], "next_training_actions": ["retry"]},
        }
        if request.request_id == "suggest_training_adjustments":
            self.retries -= 1
        return json.dumps(answers[request.request_id])
