"""Models behind a small protocol, called in batches with bounded retries; failures become a status, not an exception."""

from __future__ import annotations

import json
import time
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.models.prompts import noise_prompt

#: Questions that only ask for what the filter treats as noise.
NOISE = ("weather report", "weather forecast", "market rate", "mandi", "bhav", "mausam", "test call", "wrong number")
PROVIDERS = ("google", "openai", "anthropic", "nvidia", "vllm", "ollama")


class ModelClient(Protocol):
    def complete(self, prompt: str) -> str: ...


class StubClient:
    """Answers offline and always alike: the prompt's last line behind a fixed word."""

    def __init__(self, word: str = "Reply") -> None:
        self.word = word

    def complete(self, prompt: str) -> str:
        return f"{self.word}: {prompt.strip().splitlines()[-1] if prompt.strip() else ''}"


def provider_of(model: str, given: str | None = None) -> str:
    """The provider of a model name; a name with a colon is served locally."""
    if given:
        if given not in PROVIDERS:
            raise ValueError(f"unknown provider {given}")
        return given
    return "ollama" if ":" in model else "google"


#: Where each provider is asked unless told otherwise.
BASES = {
    "google": "https://generativelanguage.googleapis.com", "openai": "https://api.openai.com", "anthropic": "https://api.anthropic.com",
    "nvidia": "https://integrate.api.nvidia.com", "vllm": "http://localhost:8000", "ollama": "http://localhost:11434",
}


class HttpClient:
    """A model behind a provider's public HTTP interface; `send(url, headers, body) -> reply` may be replaced, as tests do."""

    def __init__(self, model: str, provider: str | None = None, key: str = "", base: str | None = None, timeout: float = 120.0, temperature: float = 0.0, send=None) -> None:
        self.model, self.provider = model, provider_of(model, provider)
        self.key, self.base, self.timeout, self.temperature = key, (base or BASES[self.provider]).rstrip("/"), timeout, temperature
        self.send = send or self._send

    def _send(self, url: str, headers: dict[str, str], body: dict) -> dict:
        request = urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json", **headers})
        with urllib.request.urlopen(request, timeout=self.timeout) as reply:
            return json.load(reply)

    def complete(self, prompt: str) -> str:
        message = [{"role": "user", "content": prompt}]
        if self.provider == "google":
            body = {"contents": [{"role": "user", "parts": [{"text": prompt}]}], "generationConfig": {"temperature": self.temperature}}
            got = self.send(f"{self.base}/v1beta/models/{self.model}:generateContent", {"x-goog-api-key": self.key}, body)
            return got["candidates"][0]["content"]["parts"][0]["text"]
        if self.provider == "anthropic":
            body = {"model": self.model, "max_tokens": 4096, "temperature": self.temperature, "messages": message}
            return self.send(f"{self.base}/v1/messages", {"x-api-key": self.key, "anthropic-version": "2023-06-01"}, body)["content"][0]["text"]
        if self.provider == "ollama":
            body = {"model": self.model, "prompt": prompt, "stream": False, "options": {"temperature": self.temperature}}
            return self.send(f"{self.base}/api/generate", {}, body)["response"]
        body = {"model": self.model, "messages": message, "temperature": self.temperature}
        return self.send(f"{self.base}/v1/chat/completions", {"Authorization": f"Bearer {self.key}"}, body)["choices"][0]["message"]["content"]


class NoiseStub:
    """The offline stand-in for the noise filter's model: a list of words, looked for in the prompt's last line."""

    def complete(self, prompt: str) -> str:
        asked = prompt.rpartition("\n")[2].lower()
        return "DISCARD" if any(word in asked for word in NOISE) else "KEEP"


def call(client: ModelClient, prompt: str, tries: int = 3, wait: float = 0.0) -> tuple[str | None, str]:
    """(reply, status): status is ok, or failed with the last error's name after `tries`."""
    error = ""
    for attempt in range(tries):
        try:
            return client.complete(prompt), "ok"
        except Exception as e:  # noqa: BLE001 - any failure of a model is a failed row
            error = type(e).__name__
            time.sleep(wait * 2**attempt)
    return None, f"failed: {error}"


def complete(df: DataFrame, key: str, prompt: Column, make: Callable[[], ModelClient], threads: int = 4, tries: int = 3) -> DataFrame:
    """(key, reply, status): one call a row, `threads` at a time in each task; the client is made once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = make()
        with ThreadPoolExecutor(threads) as pool:
            for batch in batches:
                got = list(pool.map(lambda p: call(client, p or "", tries), batch.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.string())], names=["key", "reply", "status"])

    return df.select(F.col(key).cast("string").alias("key"), prompt.alias("prompt")).mapInArrow(run, "key string, reply string, status string")


def decision_of(reply: Column) -> Column:
    """DISCARD if a reply says so; anything else, failures included, keeps the row."""
    return F.when(F.upper(F.coalesce(reply, F.lit(""))).contains("DISCARD"), F.lit("DISCARD")).otherwise(F.lit("KEEP"))


def filter_noise(df: DataFrame, key: str, question: Column, make: Callable[[], ModelClient] = NoiseStub, threads: int = 4) -> DataFrame:
    """(key, decision): KEEP or DISCARD by a model's reply; failed calls keep the row."""
    return complete(df, key, noise_prompt(question), make, threads).select("key", decision_of(F.col("reply")).alias("decision"))
