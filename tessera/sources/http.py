"""Connectors over HTTP, by the standard library: text generation, search, scraping, pages and pictures.

All are plain picklable objects whose addresses are fields, so that tests and proxies can stand in for a service. An answer
that is no success raises `StatusError`, by which callers decide whether to ask again.
"""

from __future__ import annotations

import json
import urllib.error
import urllib.parse
import urllib.request
from dataclasses import dataclass

from tessera.sources import connectors
from tessera.sources.connectors import Request, StatusError

# Addresses of the services, and which kind of call a provider understands.
PROVIDERS = {
    "openai": ("https://api.openai.com/v1", "chat"),
    "xai": ("https://api.x.ai/v1", "chat"),
    "gemini": ("https://generativelanguage.googleapis.com/v1beta", "parts"),
}
SEARCH_URL = "https://google.serper.dev/search"
SCRAPE_URL = "https://scrape.serper.dev"


def sent(url: str, body: dict | None = None, headers: dict | None = None, timeout: float = 60.0) -> tuple[int, bytes, str]:
    """Status, content and character set of the answer; a body is posted as JSON."""
    data = None if body is None else json.dumps(body, ensure_ascii=False).encode()
    ask = urllib.request.Request(url, data, {"Content-Type": "application/json", **(headers or {})} if data is not None else headers or {})
    try:
        with urllib.request.urlopen(ask, timeout=timeout) as answer:
            return answer.status, answer.read(), answer.headers.get_content_charset() or "utf-8"
    except urllib.error.HTTPError as e:
        with e:
            raise StatusError(e.code, e.headers.get("Retry-After")) from None


@dataclass(frozen=True)
class ChatClient:
    """Chat completions."""

    base_url: str
    model: str
    key: str
    temperature: float = 0.3
    timeout: float = 120.0

    def complete(self, request: Request) -> str:
        body = connectors.chat_payload(request, self.model, self.temperature)
        return connectors.chat_text(json.loads(sent(f"{self.base_url}/chat/completions", body, {"Authorization": f"Bearer {self.key}"}, self.timeout)[1])).strip()


@dataclass(frozen=True)
class PartsClient:
    """Generate-content calls."""

    base_url: str
    model: str
    key: str
    temperature: float = 0.3
    timeout: float = 120.0

    def complete(self, request: Request) -> str:
        url = f"{self.base_url}/models/{self.model}:generateContent?" + urllib.parse.urlencode({"key": self.key})
        return connectors.parts_text(json.loads(sent(url, connectors.parts_payload(request, self.temperature), None, self.timeout)[1])).strip()


def annotator(provider: str, model: str, key: str, temperature: float = 0.3, base_url: str | None = None):
    """The client of a provider; unknown providers and empty keys are errors."""
    if provider.lower() not in PROVIDERS:
        raise ValueError(f"unknown provider {provider!r}; known are {', '.join(PROVIDERS)}")
    if not key:
        raise ValueError("a provider needs an API key")
    home, kind = PROVIDERS[provider.lower()]
    return (ChatClient if kind == "chat" else PartsClient)(base_url or home, model, key, temperature)


@dataclass(frozen=True)
class Search:
    key: str
    url: str = SEARCH_URL
    timeout: float = 60.0

    def search(self, query: str, n: int) -> list[dict]:
        return json.loads(sent(self.url, {"q": query, "num": n}, {"X-API-KEY": self.key}, self.timeout)[1]).get("organic", [])


@dataclass(frozen=True)
class Scrape:
    key: str
    url: str = SCRAPE_URL
    timeout: float = 60.0

    def scrape(self, url: str) -> str | None:
        return json.loads(sent(self.url, {"url": url}, {"X-API-KEY": self.key}, self.timeout)[1]).get("text")


@dataclass(frozen=True)
class Pages:
    """Pages as text, in the character set that the answer names."""

    timeout: float = 60.0

    def fetch(self, url: str) -> tuple[int, str]:
        status, content, charset = sent(url, timeout=self.timeout)
        return status, content.decode(charset, "replace")


@dataclass(frozen=True)
class Pictures:
    timeout: float = 60.0

    def fetch(self, url: str) -> tuple[int, bytes]:
        return sent(url, timeout=self.timeout)[:2]
