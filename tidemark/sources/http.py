"""A byte source over HTTP: polite, cached, and strict about being refused. It lands raw bytes; no query reads the net."""

from __future__ import annotations

import gzip
import hashlib
import json
import os
import random
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

RETRIED = frozenset({408, 429, 500, 502, 503, 504})


class Refused(RuntimeError):
    """The server refuses this client: stop, do not try again."""


class Transient(RuntimeError):
    """Nothing came after all tries."""


@dataclass
class Client:
    """Fetches with a fixed distance between requests, a cache by address and range, and growing pauses between tries.

    ``open_url(url, headers, timeout)`` returns (status, bytes); it, ``clock`` and ``sleep`` can be replaced in tests.
    """

    agent: str
    cache: str | None = None
    per_second: float = 5.0
    tries: int = 4
    timeout: float = 45.0
    ttl: dict[str, float] = field(default_factory=lambda: {"submissions": 21_600, "xbrl": 21_600})
    open_url: Callable = None
    clock: Callable = time.monotonic
    sleep: Callable = time.sleep
    _next: float = 0.0

    def __post_init__(self):
        if not self.agent.strip():
            raise ValueError("a user agent is required")
        self.open_url = self.open_url or _open

    def _wait(self) -> None:
        now = self.clock()
        if now < self._next:
            self.sleep(self._next - now)
        self._next = max(now, self._next) + 1 / self.per_second

    def _path(self, url: str, span: str | None) -> str | None:
        return self.cache and os.path.join(self.cache, hashlib.sha256(f"{url}|{span or ''}".encode()).hexdigest()[:32] + ".gz")

    def _fresh(self, path: str | None, url: str) -> bool:
        if not path or not os.path.exists(path):
            return False
        limit = next((t for k, t in self.ttl.items() if k in url), None)
        return limit is None or time.time() - os.path.getmtime(path) < limit

    def get(self, url: str, span: str | None = None, missing_ok: bool = False) -> bytes | None:
        """Bytes of an address; None for a missing one where that is allowed."""
        path = self._path(url, span)
        if self._fresh(path, url):
            with gzip.open(path) as f:
                return f.read()
        headers = {"User-Agent": self.agent} | ({"Range": f"bytes={span}"} if span else {})
        for turn in range(self.tries):
            self._wait()
            try:
                status, body = self.open_url(url, headers, self.timeout)
            except OSError:
                status, body = 0, b""
            if status in (200, 206):
                if path:
                    os.makedirs(self.cache, exist_ok=True)
                    with gzip.open(f"{path}.{os.getpid()}", "wb") as f:
                        f.write(body)
                    os.replace(f"{path}.{os.getpid()}", path)
                return body
            if status == 403:
                raise Refused(url)
            if status == 404 and missing_ok:
                return None
            if status and status not in RETRIED:
                raise RuntimeError(f"{status} for {url}")
            self.sleep(2**turn + random.random())
        raise Transient(url)

    def get_json(self, url: str) -> object:
        try:
            return json.loads(self.get(url).decode("utf-8", "ignore"))
        except ValueError as e:
            raise RuntimeError(f"no JSON at {url}") from e

    def reachable(self, probe: str) -> bool:
        """Tells a missing file from a refusal: an address known to exist is asked for."""
        try:
            return self.get(probe) is not None
        except (Refused, Transient):
            return False


def _open(url: str, headers: dict[str, str], timeout: float) -> tuple[int, bytes]:
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=timeout) as r:  # noqa: S310
            return r.status, r.read()
    except urllib.error.HTTPError as e:
        return e.code, b""


class PoliteSource(DataSource):
    """``spark.read.format("polite_http").option("urls", json)``: (url, status, body), one partition, so one rate for all."""

    @classmethod
    def name(cls) -> str:
        return "polite_http"

    def schema(self) -> str:
        return "url string, found boolean, body binary"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self):
        return [InputPartition(0)]

    def read(self, partition):
        o = self.options
        client = Client(o["agent"], o.get("cache"), float(o.get("persecond", 5)), int(o.get("tries", 4)))
        for url in json.loads(o["urls"]):
            body = client.get(url, o.get("range"), missing_ok=True)
            yield url, body is not None, body
