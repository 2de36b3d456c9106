"""Python data source over paged reviews, read as a batch or as a resumable stream.

    spark.dataSource.register(ReviewPages)
    spark.read.format("review_pages").options(apps="[[10, 120], [20, null]]", **config.as_options()).load()

Applications are dealt to `lanes` input partitions (one if not given). All requests
together keep the allowed rate: a partition waits as many intervals as there are
partitions in all the reads that run side by side (`side_by_side`, one if not given).

`client` names a factory (ReviewApi if not given) that returns an object with
page(app_id, cursor) and summary(app_id); it gets the configuration and, by name,
the options beginning with "client.". mode="summary" reads one row of counts per
application.

As a stream (`readStream`, option `state`: a shared folder) an offset is the number of
pages read per application. Where a page ends the task writes the service's next cursor
into the state folder, so that the next micro-batch, or a restarted query, goes on at
that page; a micro-batch that is repeated reads the same pages again.
"""

from __future__ import annotations

import importlib
import json
import uuid
from collections.abc import Callable, Iterator

import pyarrow.fs as pf
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from millrace.session import EngineConfig
from millrace.sources.http import RateLimiter, fetch_json, get_with_retry
from millrace.sources.paging import FIRST_CURSOR, PageState, Step, pages, read_pages

REVIEW_ROWS = T.StructType(
    [
        T.StructField("recommendation_id", T.LongType()),
        T.StructField("app_id", T.LongType()),
        T.StructField("payload", T.StringType()),
        T.StructField("timestamp_created", T.LongType()),
        T.StructField("timestamp_updated", T.LongType()),
    ]
)
SUMMARY_ROWS = T.StructType(
    [
        T.StructField("app_id", T.LongType()),
        T.StructField("total_reviews", T.LongType()),
        T.StructField("total_positive", T.LongType()),
        T.StructField("total_negative", T.LongType()),
        T.StructField("review_score", T.IntegerType()),
        T.StructField("review_score_desc", T.StringType()),
    ]
)


def review_row(app_id: int, review: dict) -> tuple:
    """A stored row of one review; a missing id or timestamp raises KeyError."""
    created, updated = review["timestamp_created"], review["timestamp_updated"]
    return int(review["recommendationid"]), app_id, json.dumps(review), created, updated


def summary_row(app_id: int, answer: dict) -> tuple:
    """Counts of one application; an answer without a summary gives NULLs."""
    found = answer.get("query_summary") or {}
    return (app_id, *(found.get(f.name) for f in SUMMARY_ROWS.fields[1:]))


class ReviewApi:
    """Requests of the review service, one answer each; spacing and retries are the reader's."""

    def __init__(self, config: EngineConfig = EngineConfig(), fetch: Callable[..., dict] = fetch_json):
        self.config, self.fetch = config, fetch

    def _get(self, app_id: int, **params) -> dict:
        # off-topic reviews are included in pages and totals alike
        fixed = {"json": 1, "language": self.config.review_language, "purchase_type": "all", "filter_offtopic_activity": 0}
        return self.fetch(f"{self.config.review_api_url}/{app_id}", fixed | params)

    def page(self, app_id: int, cursor: str) -> dict:
        return self._get(app_id, num_per_page=self.config.page_size, filter=self.config.page_order, cursor=cursor)

    def summary(self, app_id: int) -> dict:
        return self._get(app_id, num_per_page=0, filter="all")


class RecordedClient:
    """Answers from JSON text, for tests and offline runs: {"pages": {app: {cursor: answer}}, "summaries": {app: answer}}."""

    def __init__(self, config: EngineConfig, data: str):
        self.data = json.loads(data)

    def page(self, app_id: int, cursor: str) -> dict:
        return self.data["pages"].get(str(app_id), {}).get(cursor, {})

    def summary(self, app_id: int) -> dict:
        return self.data["summaries"].get(str(app_id), {})


class Apps(InputPartition):
    """Applications of one task, and how many tasks share the allowed rate."""

    def __init__(self, apps: list, tasks: int):
        super().__init__(None)
        self.apps, self.tasks = apps, tasks


class _Requests:
    """What batch and stream readers share: options, client, spacing and retries."""

    def __init__(self, options: dict):
        self.options, self.config = dict(options), EngineConfig.from_options(options)
        self.side_by_side = int(self.options.get("side_by_side", 1))

    def deal(self) -> list[Apps]:
        apps = json.loads(self.options["apps"])
        lanes = max(1, min(len(apps), int(self.options.get("lanes", 1))))
        return [Apps(apps[i::lanes], lanes * self.side_by_side) for i in range(lanes)]

    def client(self):
        module, _, factory = self.options.get("client", f"{__name__}:ReviewApi").partition(":")
        given = {k.removeprefix("client."): v for k, v in self.options.items() if k.startswith("client.")}
        return getattr(importlib.import_module(module), factory)(self.config, **given)

    def asking(self, tasks: int) -> Callable:
        """A caller whose requests wait their turn, in one of so many tasks, and are retried."""
        limiter = RateLimiter(self.config.http_min_interval_seconds * tasks)
        return lambda f, *a: get_with_retry(lambda: f(*a), limiter, self.config)


class ReviewPagesReader(_Requests, DataSourceReader):
    def partitions(self) -> list[Apps]:
        return self.deal()

    def read(self, partition: Apps) -> Iterator[tuple]:
        client, ask = self.client(), self.asking(partition.tasks)
        for app_id, total in partition.apps:
            if self.options.get("mode", "reviews") == "summary":
                yield summary_row(app_id, ask(client.summary, app_id))
                continue
            for page in pages(lambda cursor: ask(client.page, app_id, cursor), total, self.config):
                for review in page:
                    yield review_row(app_id, review)


class Progress:
    """Where the pages of each application end, in files that all machines see: cursor, rows so far and whether that was all."""

    def __init__(self, path: str):
        self.fs, self.root = pf.FileSystem.from_uri(path)

    def at(self, app_id: int, page: int) -> dict:
        if not page:
            return {"cursor": FIRST_CURSOR, "fetched": 0, "done": False}
        with self.fs.open_input_stream(f"{self.root}/{app_id}/{page}.json") as f:
            return json.loads(f.read())

    def put(self, app_id: int, page: int, state: PageState, step: Step | None) -> None:
        self.fs.create_dir(f"{self.root}/{app_id}", recursive=True)
        part = f"{self.root}/{app_id}/.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(part) as f:
            f.write(json.dumps({"cursor": state.cursor, "fetched": state.fetched, "done": step in (Step.END, Step.GIVE_UP)}).encode())
        self.fs.move(part, f"{self.root}/{app_id}/{page}.json")

    def last(self, app_id: int) -> int:
        found = self.fs.get_file_info(pf.FileSelector(f"{self.root}/{app_id}", allow_not_found=True))
        return max((int(i.base_name[:-5]) for i in found if i.base_name[0] != "." and i.base_name.endswith(".json")), default=0)


class Pages(InputPartition):
    """Pages [begin, end) of applications: (app, total, begin, end)."""

    def __init__(self, spans: list, tasks: int):
        super().__init__(None)
        self.spans, self.tasks = spans, tasks


class ReviewPagesStream(_Requests, DataSourceStreamReader):
    def __init__(self, options: dict):
        super().__init__(options)
        self.progress = Progress(self.options["state"])

    def initialOffset(self) -> dict:
        return {str(a): 0 for a, _ in json.loads(self.options["apps"])}

    def latestOffset(self) -> dict:
        """A micro-batch's worth of pages beyond the last known end, for applications that have more."""
        out = {}
        for a, _ in json.loads(self.options["apps"]):
            page = self.progress.last(a)
            out[str(a)] = page if self.progress.at(a, page)["done"] else page + self.config.pages_per_batch
        return out

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        lanes = []
        for part in self.deal():
            spans = [(a, t, start.get(str(a), 0), end[str(a)]) for a, t in part.apps if end[str(a)] > start.get(str(a), 0)]
            lanes += [Pages(spans, part.tasks)] if spans else []
        return lanes

    def read(self, partition: Pages) -> Iterator[tuple]:
        client, ask = self.client(), self.asking(partition.tasks)
        for app_id, total, begin, end in partition.spans:
            known = self.progress.at(app_id, begin)
            state, step = PageState(total, known["cursor"], known["fetched"]), None
            if not known["done"]:
                for step, page in read_pages(lambda cursor: ask(client.page, app_id, cursor), state, end - begin, self.config):
                    for review in page:
                        yield review_row(app_id, review)
            self.progress.put(app_id, end, state, Step.END if known["done"] else step)


class ReviewPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "review_pages"

    def schema(self) -> T.StructType:
        return SUMMARY_ROWS if self.options.get("mode") == "summary" else REVIEW_ROWS

    def reader(self, schema: T.StructType) -> ReviewPagesReader:
        return ReviewPagesReader(self.options)

    def streamReader(self, schema: T.StructType) -> ReviewPagesStream:
        return ReviewPagesStream(self.options)
