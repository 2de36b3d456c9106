"""Requests of the sources: spacing, retries and JSON over HTTP. They run inside readers or on the driver, not as Spark operators."""

from __future__ import annotations

import json
import threading
import time
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterable

from millrace.session import EngineConfig


class RateLimiter:
    """Lets callers pass in turn, none sooner than interval seconds after the one before.

    Waiting happens inside the turn, so threads queue up. Tasks on several machines
    share no turn: each of n gets n times the interval.
    """

    def __init__(self, interval: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.interval, self.clock, self.sleep = interval, clock, sleep
        self._turn, self._last = threading.Lock(), None

    def wait(self) -> None:
        with self._turn:
            if self._last is not None and (early := self._last + self.interval - self.clock()) > 0:
                self.sleep(early)
                self._last += self.interval
            else:
                self._last = self.clock()


def get_with_retry(
    fetch: Callable[[], dict],
    limiter: RateLimiter | None = None,
    config: EngineConfig = EngineConfig(),
    retry_on: tuple[type[BaseException], ...] = (OSError, ValueError),
    sleep: Callable[[float], None] = time.sleep,
) -> dict:
    """Call fetch until it succeeds; transport errors, error statuses and bad JSON are all retried.

    The pause before retry n is base**n; after the last retry the error is raised.
    """
    for attempt in range(1, config.http_max_retries + 2):
        if limiter:
            limiter.wait()
        try:
            return fetch()
        except retry_on:
            if attempt > config.http_max_retries:
                raise
            sleep(config.http_backoff_base_seconds**attempt)
    raise AssertionError("unreachable")


def open_url(url: str, params: dict | None = None, headers: dict | None = None, post: bool = False, timeout: float = 20.0):
    """A response to read from; error statuses raise OSError (urllib's HTTPError is one)."""
    query = urllib.parse.urlencode(params or {})
    body = query.encode() if post else None
    request = urllib.request.Request(url if post or not query else f"{url}?{query}", data=body, headers=headers or {})
    return urllib.request.urlopen(request, timeout=timeout)


def fetch_json(url: str, params: dict | None = None, headers: dict | None = None, post: bool = False, timeout: float = 20.0) -> dict:
    with open_url(url, params, headers, post, timeout) as answer:
        return json.loads(answer.read())


def stream_bytes(url: str, chunk: int, timeout: float = 600.0) -> Iterable[bytes]:
    with open_url(url, timeout=timeout) as answer:
        while part := answer.read(chunk):
            yield part
