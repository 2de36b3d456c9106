"""Catalog dumps: token cache, download and CSV scan."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import EngineConfig
from millrace.sources.http import fetch_json, stream_bytes

#: Refresh margin, default lifetime, download chunk.
REFRESH_MARGIN_S, DEFAULT_TTL_S, CHUNK_BYTES = 60, 3600, 1 << 20


class TokenCache:
    """Client-credentials token, asked for anew a minute before it ends."""

    def __init__(self, request: Callable[[], dict], clock: Callable[[], float] = time.monotonic):
        self.request, self.clock = request, clock
        self.token, self.until = None, float("-inf")

    def get(self) -> str:
        if self.token is None or self.clock() >= self.until:
            answer = self.request()
            self.token = answer["access_token"]
            self.until = self.clock() + answer.get("expires_in", DEFAULT_TTL_S) - REFRESH_MARGIN_S
        return self.token


class CatalogApi:
    """The catalog's dump service: finds the short-lived address of a dump with a client's token."""

    def __init__(self, client_id: str, client_secret: str, config: EngineConfig = EngineConfig(), fetch: Callable[..., dict] = fetch_json):
        self.client_id, self.config, self.fetch = client_id, config, fetch
        grant = {"client_id": client_id, "client_secret": client_secret, "grant_type": "client_credentials"}
        self.tokens = TokenCache(lambda: fetch(config.catalog_token_url, grant, post=True))

    def locate(self, endpoint: str) -> str:
        headers = {"Client-ID": self.client_id, "Authorization": f"Bearer {self.tokens.get()}", "Accept": "application/json"}
        found = self.fetch(f"{self.config.catalog_api_url}/dumps/{endpoint}", headers=headers).get("s3_url")
        if not found:
            raise ValueError(f"the service has no address for dump {endpoint}")
        return found


def download_dump(endpoint: str, dest_dir: Path, locate: Callable[[str], str], stream: Callable[[str, int], Iterable[bytes]] = stream_bytes) -> Path:
    """Look up the signed address of a dump and write it to dest_dir in chunks.

    Runs on the driver, outside Spark. The file appears under its name when it is whole.
    """
    folder = Path(dest_dir)
    folder.mkdir(parents=True, exist_ok=True)
    path, part = folder / f"{endpoint}.csv", folder / f".{endpoint}.part"
    with part.open("wb") as out:
        for chunk in stream(locate(endpoint), CHUNK_BYTES):
            out.write(chunk)
    return part.replace(path)


def read_dump(spark: SparkSession, path: str, columns: list[str], row_no: str | None = None) -> DataFrame:
    """Header-keyed rows of text; fields may be very long and hold newlines.

    Columns that the file lacks are NULL. Bytes that aren't UTF-8 become U+FFFD.
    Spark reads a blank field as NULL. row_no adds the file order; it needs one
    unsplit file, which multiLine guarantees.
    """
    reader = (
        spark.read.option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("maxCharsPerColumn", -1)
        .option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE")
    )
    raw = reader.csv(path)
    out = raw.select(*[(F.col(f"`{c}`") if c in raw.columns else F.lit(None)).cast(T.StringType()).alias(c) for c in columns])
    return out.withColumn(row_no, F.monotonically_increasing_id()) if row_no else out
