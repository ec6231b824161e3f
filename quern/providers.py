"""Models behind one interface. The default answers from the text alone, so results can be repeated and compared.

A provider object is built in each task (iterator functions), never per row. :class:`Pool` turns through several
models, rests those that hit a limit and retries; its clock and sleep are parameters, so tests need no waiting.
"""

from __future__ import annotations

import hashlib
import re
import time
from collections.abc import Callable
from typing import Protocol


class Provider(Protocol):
    def clean(self, text: str) -> dict | None: ...
    def abstract(self, text: str) -> dict: ...
    def consolidate(self, fragments: str) -> dict: ...
    def describe(self, abstract: str) -> dict: ...
    def ask(self, abstract: str, count: int) -> list[str]: ...
    def reason(self, question: str) -> str: ...
    def answer(self, question: str, reasoning: str) -> str: ...
    def embed(self, texts: list[str]) -> list[list[float]]: ...
    def entail(self, pairs: list[tuple[str, str]]) -> list[float]: ...
    def expand(self, topic: str, count: int) -> list[str]: ...
    def tokens(self, text: str) -> list[str]: ...


_WORD = re.compile(r"[^\W_]+")


def _words(text: str) -> list[str]:
    return _WORD.findall((text or "").casefold())


class Offline:
    """The deterministic default."""

    width = 64

    def clean(self, text: str) -> dict | None:
        kept = "\n".join(x for x in (line.strip() for line in text.replace("\x00", "").split("\n")) if x)
        if not kept:
            return None
        long = sum(len(w) for w in _words(kept)) / max(len(_words(kept)), 1)
        return {"cleaned_text": kept, "topic": " ".join(_words(kept)[:3]), "difficulty": "avancado" if long > 6 else "intermediario" if long > 4.5 else "basico", "domain": "geral", "language_quality": min(10, 1 + len(set(_words(kept))) // 10)}

    def abstract(self, text: str) -> dict:
        first = re.split(r"(?<=[.!?。])\s", text.strip(), maxsplit=2)[:2]
        words = sorted({w for w in _words(text) if len(w) > 8})
        return {"abstract": " ".join(first)[:500], "keywords": words[:5]}

    def consolidate(self, fragments: str) -> dict:
        body = re.sub(r"--- FRAGMENTO \d+ ---", " ", fragments)
        return {"abstract": " ".join(body.split())[:500], "keywords": []}

    def describe(self, abstract: str) -> dict:
        return {"useless": len(_words(abstract)) < 5, "data_based": any(c.isdigit() for c in abstract)}

    def ask(self, abstract: str, count: int) -> list[str]:
        topics = [w for w in _words(abstract) if len(w) > 5]
        return [f"O que se sabe sobre {w}?" for w in list(dict.fromkeys(topics))[:count]]

    def reason(self, question: str) -> str:
        return f"## Base\n{question}"

    def answer(self, question: str, reasoning: str) -> str:
        return f"{question.rstrip('?')}: {reasoning.splitlines()[-1]}" if reasoning else ""

    def embed(self, texts: list[str]) -> list[list[float]]:
        out = []
        for text in texts:
            v = [0.0] * self.width
            for w in _words(text):
                h = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "replace"), digest_size=8).digest(), "big")
                v[h % self.width] += 1.0 if h >> 63 else -1.0
            norm = sum(x * x for x in v) ** 0.5
            out.append([x / norm for x in v] if norm else v)
        return out

    def entail(self, pairs: list[tuple[str, str]]) -> list[float]:
        """Share of the premise's words that the conclusion has."""
        out = []
        for a, b in pairs:
            have = set(_words(b))
            need = set(_words(a))
            out.append(len(need & have) / len(need) if need else 0.0)
        return out

    def expand(self, topic: str, count: int) -> list[str]:
        return [f"{topic} {i}" for i in range(1, count + 1)]

    def tokens(self, text: str) -> list[str]:
        return re.findall(r"\s*\S+|\s+$", text)


_REGISTRY: dict[str, Callable[[], Provider]] = {"offline": Offline}


def register(name: str, factory: Callable[[], Provider]) -> None:
    _REGISTRY[name] = factory


def provider(name: str) -> Provider:
    """A provider by name; unknown names raise ValueError."""
    if name not in _REGISTRY:
        raise ValueError(f"no provider is called {name}")
    return _REGISTRY[name]()


class QuotaExceeded(Exception):
    """All models rest or have failed."""


class DailyQuotaExceeded(QuotaExceeded):
    """No model will be free within the longest wait."""


def rate_limited(error: Exception) -> bool:
    s = str(error).lower()
    return any(x in s for x in ("429", "quota", "resource_exhausted"))


def daily_limited(error: Exception) -> bool:
    s = str(error).lower()
    return any(x in s for x in ("daily", "day", "user rate limit exceeded"))


class Pool:
    """Models in turn. A model that hit a limit rests for a minute, a daily limit for a day; any other error goes to the
    next model. Where all rest, the call waits for the first to be free, if that is soon enough."""

    def __init__(self, models: list[str], rest: float = 60.0, day: float = 86_400.0, longest_wait: float = 3_000.0, clock=time.time, sleep=time.sleep):
        self.models, self.rest, self.day, self.longest_wait, self.clock, self.sleep = models, rest, day, longest_wait, clock, sleep
        self.until = dict.fromkeys(models, float("-inf"))
        self.turn = 0

    def next(self) -> str | None:
        for _ in self.models:
            model = self.models[self.turn % len(self.models)]
            self.turn += 1
            if self.clock() > self.until[model]:
                return model
        return None

    def call(self, function: Callable[[str], object]) -> object:
        if not self.models:
            raise QuotaExceeded("the pool is empty")
        failed: Exception | None = None
        tries = 0
        while tries < 2 * len(self.models):
            model = self.next()
            if model is None:
                wait = min(self.until.values()) - self.clock()
                if wait > self.longest_wait:
                    raise DailyQuotaExceeded(str(failed))
                self.sleep(max(wait, 0.0) + 0.001)
                continue
            tries += 1
            try:
                return function(model)
            except Exception as error:  # noqa: BLE001 - any provider error
                failed = error
                if rate_limited(error):
                    self.until[model] = self.clock() + (self.day if daily_limited(error) else self.rest)
        raise QuotaExceeded(str(failed))


def backoff(function: Callable[[], object], tries: int = 5, base: float = 2.0, sleep=time.sleep) -> object:
    """``function()``, tried again after 1, 2, 4, ... seconds; the last error is raised."""
    for n in range(tries):
        try:
            return function()
        except Exception:  # noqa: BLE001
            if n == tries - 1:
                raise
            sleep(base**n)
    return None


def halving(function: Callable[[list], list], items: list, too_large: Callable[[Exception], bool], smallest=None) -> list:
    """``function(items)``; a batch that is too large is halved down to one item, which then gets ``smallest`` or raises."""
    try:
        return function(items)
    except Exception as error:  # noqa: BLE001
        if not too_large(error):
            raise
        if len(items) > 1:
            half = len(items) // 2
            return halving(function, items[:half], too_large, smallest) + halving(function, items[half:], too_large, smallest)
        if smallest is None:
            raise
        return [smallest]


class Paced:
    """Calls no closer together than a given number of seconds."""

    def __init__(self, seconds: float, clock=time.monotonic, sleep=time.sleep):
        self.seconds, self.clock, self.sleep, self.last = seconds, clock, sleep, float("-inf")

    def __call__(self, function: Callable[[], object]) -> object:
        wait = self.last + self.seconds - self.clock()
        if wait > 0:
            self.sleep(wait)
        self.last = self.clock()
        return function()
