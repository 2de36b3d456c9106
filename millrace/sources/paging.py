"""Cursor pagination that survives false end signals."""

from __future__ import annotations

import enum
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from millrace.operators.gating import stop_tolerance_value
from millrace.session import EngineConfig

FIRST_CURSOR = "*"


class Step(enum.Enum):
    TAKE = "take the page and move on"
    REPLAY = "ask for the same cursor again after a pause"
    END = "all there is"
    GIVE_UP = "too few rows after all retries"


@dataclass
class PageState:
    """What the reader knows between pages."""

    total: int | None
    cursor: str = FIRST_CURSOR
    fetched: int = 0
    retries: int = 0

    def decide(self, n_rows: int, next_cursor: str | None, config: EngineConfig) -> Step:
        """A page without rows, without a cursor or with the same cursor signals the end.

        Its rows, if any, are not taken. The signal is believed when the expected
        total is unknown or nearly reached; else the cursor is replayed.
        """
        if n_rows and next_cursor and next_cursor != self.cursor:
            self.retries, self.fetched, self.cursor = 0, self.fetched + n_rows, next_cursor
            return Step.TAKE
        if self.total is None or self.total - self.fetched <= stop_tolerance_value(self.total, config):
            return Step.END
        if self.retries >= config.stop_max_retries:
            return Step.GIVE_UP
        self.retries += 1
        return Step.REPLAY

    def pause(self, config: EngineConfig) -> float:
        return config.stop_backoff_base_seconds * 2 ** (self.retries - 1)


def read_pages(
    fetch: Callable[[str], dict],
    state: PageState,
    most: int | None,
    config: EngineConfig = EngineConfig(),
    sleep: Callable[[float], None] = time.sleep,
) -> Iterator[tuple[Step, list[dict]]]:
    """(step, rows) from where state stands, at most so many pages; the last step tells whether there are more. state moves on."""
    n = 0
    while most is None or n < most:
        answer = fetch(state.cursor)
        rows = answer.get("reviews") or []
        step = state.decide(len(rows), answer.get("cursor"), config)
        if step is Step.TAKE:
            n += 1
            yield step, rows
        elif step is Step.REPLAY:
            sleep(state.pause(config))
        else:
            yield step, []
            return


def pages(
    fetch: Callable[[str], dict],
    total: int | None,
    config: EngineConfig = EngineConfig(),
    sleep: Callable[[float], None] = time.sleep,
) -> Iterator[list[dict]]:
    """Pages of rows, one in memory at a time."""
    for step, rows in read_pages(fetch, PageState(total), None, config, sleep):
        if step is Step.TAKE:
            yield rows
