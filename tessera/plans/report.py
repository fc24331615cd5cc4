"""The Markdown report of a run, and a log of metrics and artifacts kept in memory."""

from __future__ import annotations

import json
import os

from tessera.functions.jsontext import _parsed


def records(path: str) -> list:
    """Objects of a JSON-lines file: whole lines, else what stands between the outer braces; other lines are left out."""
    found = []
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            for line in filter(None, map(str.strip, f)):
                good, value = _parsed(line)
                if not good:
                    good, value = _parsed(line[line.find("{") : line.rfind("}") + 1])
                if good:
                    found.append(value)
    return found


def _fenced(value) -> str:
    return "```\n" + json.dumps(value, indent=2, ensure_ascii=False, default=str) + "\n```\n"


def render(run_dir: str, dataset_summary: dict, component_selection: dict, iterations: list[dict], cluster_preview: dict, error_analysis: dict, title: str = "Fine-tuning report") -> str:
    """Write report.md and return its path."""
    # Names and order of the sections.
    sections = [
        ("Dataset Summary", _fenced(dataset_summary)),
        ("Agent Decisions", _fenced(records(os.path.join(run_dir, "agent_decisions.jsonl")))),
        ("Selected Components", _fenced(component_selection)),
        ("Training Iterations", "\n".join(f"### Iteration {r['iter_idx']}\n\n{_fenced(r)}" for r in iterations)),
        ("Failure Clusters", _fenced(cluster_preview)),
        ("Error Analysis", _fenced(error_analysis)),
    ]
    path = os.path.join(run_dir, "report.md")
    os.makedirs(run_dir, exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join([f"# {title}\n", *(f"## {name}\n\n{body}" for name, body in sections)]))
    return path


class Journal:
    """Metrics and artifacts of a run."""

    def __init__(self, run_dir: str, **config):
        self.run_dir, self.config, self.metrics, self.artifacts = run_dir, config, [], []

    def log(self, metrics: dict, step: int | None = None) -> None:
        self.metrics.append({"step": step, **metrics})

    def log_artifact(self, path: str, kind: str = "file") -> None:
        self.artifacts.append({"path": path, "type": kind})

    def finalize(self, **parts) -> str:
        return render(self.run_dir, **parts)
