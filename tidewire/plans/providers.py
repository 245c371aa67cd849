"""Model providers over an injectable transport: a local server, hosted ones with OpenAI's shape, and their choice."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from .model import Calls, Chain, OutOfQuota, RateLimited

# The headers that say how long to wait, the wait without one, and statuses that end a provider's day.
RETRY_HEADERS = ("retry-after", "x-ratelimit-reset-requests", "x-ratelimit-reset-tokens")
DEFAULT_WAIT = 10.0
REFUSED = (401, 402, 403)
DAILY = re.compile(r"per day|daily|\b(?:tpd|rpd)\b", re.IGNORECASE)

_UNITS = {"h": 3600.0, "m": 60.0, "s": 1.0, "ms": 0.001}


@dataclass(frozen=True)
class Reply:
    status: int
    body: str
    headers: Mapping[str, str]


#: (url, headers, JSON body) -> reply; raises OSError where nothing answers.
Transport = Callable[[str, Mapping[str, str], str], Reply]


def seconds(text: str | None) -> float | None:
    """Seconds of a header such as 7.5, 2m59.5s or 120ms."""
    text = (text or "").strip().lower()
    if re.fullmatch(r"\d+(?:\.\d+)?", text):
        return float(text)
    parts = re.findall(r"(\d+(?:\.\d+)?)(ms|h|m|s)", text)
    return sum(float(n) * _UNITS[u] for n, u in parts) if parts and "".join(n + u for n, u in parts) == text else None


def retry_after(headers: Mapping[str, str]) -> float:
    """How long to wait: the longest of what the headers say."""
    low = {k.lower(): v for k, v in headers.items()}
    waits = [s for s in (seconds(low.get(name)) for name in RETRY_HEADERS) if s is not None]
    return max(waits, default=DEFAULT_WAIT)


def is_daily_limit(body: str) -> bool:
    """Whether a refusal is of the day's allowance, for which no wait helps."""
    return DAILY.search(body) is not None


def hosted(transport: Transport, url: str, model: str, key: str, wait: Callable[[float], None] = lambda s: None) -> Callable[[str], str]:
    """A chat endpoint of OpenAI's shape."""

    def ask(prompt: str) -> str:
        body = json.dumps({"model": model, "messages": [{"role": "user", "content": prompt}], "temperature": 0, "response_format": {"type": "json_object"}})
        reply = transport(f"{url.rstrip('/')}/chat/completions", {"Authorization": f"Bearer {key}", "Content-Type": "application/json"}, body)
        if reply.status == 429:
            if is_daily_limit(reply.body):
                raise OutOfQuota
            wait(retry_after(reply.headers))
            raise RateLimited
        if reply.status in REFUSED:
            raise OutOfQuota
        if reply.status >= 400:
            raise OSError(f"status {reply.status}")
        return json.loads(reply.body)["choices"][0]["message"]["content"]

    return ask


def local(transport: Transport, url: str, model: str) -> Callable[[str], str]:
    """A local server that generates for one prompt; one that isn't there is out of quota."""

    def ask(prompt: str) -> str:
        body = json.dumps({"model": model, "prompt": prompt, "stream": False, "format": "json", "think": False})
        try:
            reply = transport(f"{url.rstrip('/')}/api/generate", {"Content-Type": "application/json"}, body)
        except OSError as e:
            raise OutOfQuota from e
        if reply.status >= 400:
            raise OSError(f"status {reply.status}")
        return json.loads(reply.body)["response"]

    return ask


def provider(settings, transport: Transport, wait: Callable[[float], None] = lambda s: None) -> Chain:
    """The chain of the providers that ``settings`` (``sources.settings.Settings``) names, hosted ones before the local."""
    links = [Calls(hosted(transport, url, model, key, wait), settings.model_calls) for url, model, key in settings.hosted]
    if settings.local_url:
        links.append(Calls(local(transport, settings.local_url, settings.local_model), settings.model_calls))
    return Chain(links)
