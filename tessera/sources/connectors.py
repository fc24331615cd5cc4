"""What the outside world must offer, and deterministic offline stand-ins.

Connectors are plain picklable objects; Spark tasks call them from Arrow-batched functions.
"""

from __future__ import annotations

import base64
import json
import mimetypes
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol


class SearchConnector(Protocol):
    def search(self, query: str, n: int) -> list[dict]: ...


class ScrapeConnector(Protocol):
    def scrape(self, url: str) -> str | None: ...


class PageConnector(Protocol):
    def fetch(self, url: str) -> tuple[int, str]: ...


class PictureConnector(Protocol):
    def fetch(self, url: str) -> tuple[int, bytes]: ...


class Annotator(Protocol):
    def complete(self, request: Request) -> str: ...


class Generator(Protocol):
    def generate(self, prompt: str, max_new_tokens: int) -> str: ...


class Tokenizer(Protocol):
    def encode(self, text: str) -> list[int]: ...


class Trainer(Protocol):
    def train(self, rows, config, folder: str) -> list[dict]: ...


class Hub(Protocol):
    def push(self, path: str, repo: str, kind: str, token: str) -> str: ...


@dataclass(frozen=True)
class Request:
    request_id: str
    user_message: str
    system_prompt: str | None = None
    images: tuple[str, ...] = ()
    generation_config: dict = field(default_factory=dict)


class StatusError(Exception):
    """An HTTP answer that is no success."""

    def __init__(self, status: int, retry_after: str | None = None):
        super().__init__(f"HTTP status {status}")
        self.status, self.retry_after = status, retry_after


#: Statuses that a further attempt cannot mend.
FINAL_STATUS = (400, 401, 403, 404)


def pause(error: Exception, attempt: int, step: float = 2.0) -> float:
    """Seconds before the next attempt: grows by `step`; a busy service gets five seconds or what it asks for."""
    seconds = step * attempt
    if isinstance(error, StatusError) and error.status == 429:
        try:
            asked = float(error.retry_after or 0)
        except ValueError:
            asked = 0.0
        seconds = max(seconds, asked, 5.0)
    return seconds


def persistent(call: Callable[[], object], attempts: int = 3, step: float = 2.0, sleep: Callable[[float], None] = time.sleep):
    """The result of `call`, tried up to `attempts` times; what it raises last is raised."""
    for attempt in range(1, attempts + 1):
        try:
            return call()
        except Exception as e:
            if attempt == attempts or isinstance(e, StatusError) and e.status in FINAL_STATUS:
                raise
            sleep(pause(e, attempt, step))


def _inline(path: str) -> tuple[str, str]:
    with open(path, "rb") as f:
        return mimetypes.guess_type(path)[0] or "application/octet-stream", base64.b64encode(f.read()).decode()


def chat_payload(request: Request, model: str, temperature: float = 0.2) -> dict:
    """Body of a chat-completions call."""
    content: object = request.user_message
    if request.images:
        pictures = [{"type": "image_url", "image_url": {"url": "data:{};base64,{}".format(*_inline(p))}} for p in request.images]
        content = [{"type": "text", "text": request.user_message}, *pictures]
    system = [{"role": "system", "content": request.system_prompt}] if request.system_prompt else []
    messages = [*system, {"role": "user", "content": content}]
    return {"model": model, "temperature": temperature, "messages": messages, "response_format": {"type": "json_object"}, **request.generation_config}


def chat_text(body: dict) -> str:
    content = body["choices"][0]["message"]["content"]
    return content if isinstance(content, str) else "".join(p.get("text", "") for p in content)


def parts_payload(request: Request, temperature: float = 0.2) -> dict:
    """Body of a generate-content call."""
    parts: list[dict] = [{"text": request.user_message}]
    for p in request.images:
        kind, data = _inline(p)
        parts.append({"inline_data": {"mime_type": kind, "data": data}})
    body: dict = {"contents": [{"role": "user", "parts": parts}], "generationConfig": {"responseMimeType": "application/json", "temperature": temperature, **request.generation_config}}
    if request.system_prompt:
        body["systemInstruction"] = {"parts": [{"text": request.system_prompt}]}
    return body


def parts_text(body: dict) -> str:
    return "".join(p.get("text", "") for p in body["candidates"][0]["content"]["parts"])


# Offline stand-ins


class FixedSearch:
    """Made-up results, the same for the same query."""

    def search(self, query: str, n: int) -> list[dict]:
        word = "".join(c if c.isalnum() else "-" for c in query.lower())[:40].strip("-") or "empty"
        return [{"link": f"https://site{i}.example.org/{word}", "snippet": f"{query} {i}"} for i in range(n)]


class FixedScrape:
    def scrape(self, url: str) -> str:
        return f"Text of {url}. It tells something about its subject, and then it ends."


class FixedPages:
    """A page with one large and one small picture; addresses that end in `gone` do not answer."""

    def fetch(self, url: str) -> tuple[int, str]:
        if url.endswith("gone"):
            return 404, ""
        return 200, f'<p>Before {url}<img src="/a.jpg" width="800" height="600">after<img src="b.jpg" width="10" height="10"></p>'


class FixedPictures:
    """The first bytes of a picture of 800 by 600."""

    def fetch(self, url: str) -> tuple[int, bytes]:
        return 200, b"\x89PNG\r\n\x1a\n\x00\x00\x00\rIHDR" + (800).to_bytes(4, "big") + (600).to_bytes(4, "big")


class FixedAnnotator:
    """Answers by what the system prompt asks for; output is fenced like a model's."""

    def complete(self, request: Request) -> str:
        ask, text = request.system_prompt or "", request.user_message
        head = " ".join(text.split()[-3:]) or "nothing"
        if "SUBCATEGORIES" in ask:
            value: dict = {"subcategories": [{"name": f"{head} {i}", "description": f"Part {i}"} for i in (1, 2)]}
        elif "CATEGORIES" in ask:
            value = {"categories": [{"name": f"Topic {c}", "description": f"About {c}"} for c in "AB"]}
        elif "QUERIES" in ask:
            value = {"search_queries": [f"{head} history", f"{head} today"]}
        else:
            pair = {"instruction": f"Explain {head}.", "response": f"{head} is explained."}
            value = {
                "knowledge_qa": [{"question": f"What is {head} {i}?", "answer": f"It is {i}."} for i in range(1, 4)],
                "detailed_explanation": pair, "analytical_reasoning": pair,
                "conversational_exchange": {"opening_question": "So?", "opening_response": "Yes.", "follow_up_question": "Why?", "follow_up_response": "Because."},
                "metadata": {"language": "en", "topics": [head], "domain": "other"},
            }
        return f"Here it is:\n```json\n{json.dumps(value, ensure_ascii=False)}\n```"


class EchoGenerator:
    """Repeats the prompt and the start of it, as a model that decodes prompt and answer together."""

    def generate(self, prompt: str, max_new_tokens: int) -> str:
        return prompt + "\n" + " ".join(prompt.split()[:max_new_tokens])


class WordTokenizer:
    """Ids by the bytes of a word and their places, for padding and truncation without a vocabulary file."""

    pad = 0

    def encode(self, text: str) -> list[int]:
        return [1 + sum(i * b for i, b in enumerate(w.encode(), 1)) % 30_000 for w in text.split()]


class CurveTrainer:
    """A made-up falling loss, so that metric folding, search and retries run without a model."""

    def train(self, rows, config, folder: str) -> list[dict]:
        n, out = rows.count(), []
        for step in range(config.eval_steps, config.max_steps + 1, config.eval_steps):
            loss = 1.0 + abs(config.lr - 1e-4) * 1000 + 5.0 / (step * config.batch_size * config.grad_accum / 16)
            out += [{"step": step, "loss": round(loss, 6)}, {"step": step, "eval_loss": round(loss + 0.1 + 1.0 / (n + 1), 6)}]
        return out + [{"step": config.max_steps, "train_loss": round(sum(r.get("loss", 0) for r in out) / max(1, len(out) / 2), 6)}]
