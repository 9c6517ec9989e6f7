"""``rest_json``: a Python Data Source for paged JSON listings.

    spark.read.format("rest_json")
        .option("url", "/customers/7/orders")          # base URL (path for the transport)
        .option("transport", json.dumps({"kind": "file", "root": ...}))
        .option("mode", "sequential")                   # sequential | threaded | async
        .option("total_pages", "12")                    # threaded: given by the caller
        .option("partitions", "64")                     # at most so many input partitions
        .option("in_flight", "5")                       # async, threaded: open requests of a partition
        .option("on_error", "fail")                     # fail | drop
        .load()

One row per fetched page: ``page, http_status, status, attempts, error,
payload`` (the page body; ``records`` is exploded downstream with
``explode_page_records``).

sequential / async: the first page is the bare URL and reports
``total_pages``; it is fetched once while planning (on the driver, one
request) and carried into the first partition, so it is never fetched twice.
If it fails, the read fails, whatever ``on_error`` says: without it the number
of pages is unknown. Pages 2..N are split into at most ``partitions`` ranges
that executors fetch in parallel; within a range, async and threaded modes keep up to
``in_flight`` requests open and pass rows on in page order. Across ranges page order is the
``page`` column, not arrival order.
threaded: URLs ``?page=1..N`` with N from the option; failed pages are
dropped (``on_error=drop``, the client's behaviour) or fail the read.
429 answers are waited for without bound unless ``max_429`` is given; a page
that is still throttled then fails the read, it is never dropped.
The auth token (``transport.token``) is never part of a row or the plan text
shown by ``explain`` (options are not printed by the scan node).
"""

from __future__ import annotations

import json
from collections import deque
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from feedlake.sources import transport as tp

SCHEMA = "page bigint, http_status bigint, status string, attempts bigint, error string, payload string"


class PagePartition(InputPartition):
    """Pages start..stop-1, and the first page's landed row where it was fetched while planning."""

    def __init__(self, start: int, stop: int, first: dict | None = None):
        super().__init__((start, stop))
        self.start, self.stop, self.first = start, stop, first


def _page_url(base: str, page: int, bare_first: bool) -> str:
    if page == 1 and bare_first:
        return base
    sep = "&" if "?" in base else "?"
    return f"{base}{sep}page={page}"


class RestJsonReader(DataSourceReader):
    def __init__(self, options: dict):
        self.url = options["url"]
        self.conf = json.loads(options["transport"])
        self.mode = options.get("mode", "sequential")
        if self.mode not in ("sequential", "threaded", "async"):
            raise ValueError(f"unknown mode {self.mode!r}")
        self.on_error = options.get("on_error", "drop" if self.mode == "threaded" else "fail")
        if self.on_error not in ("fail", "drop"):
            raise ValueError(f"unknown on_error {self.on_error!r}")
        self.partition_count = max(1, int(options.get("partitions", "64")))
        self.total = options.get("total_pages")
        self.in_flight = max(1, int(options.get("in_flight", "5")))
        self.quota = int(options["quota_per_partition"]) if options.get("quota_per_partition") else None
        self.max_429 = int(options["max_429"]) if options.get("max_429") else None

    def _fetch(self, page: int, limiter) -> dict | None:
        """The page's row; None for a failed page that may be dropped."""
        got = tp.fetch(self.conf, _page_url(self.url, page, self.mode != "threaded"), limiter, max_429=self.max_429)
        if got["status"] != "ok":
            first = page == 1 and self.mode != "threaded"
            if self.on_error == "drop" and not first and tp.may_drop(got):
                return None
            raise RuntimeError(f"Failed to fetch {self.url} page {page}: {got['error']}")
        return dict(page=page, **got)

    def partitions(self):
        if self.mode == "threaded":
            if self.total is None:
                raise ValueError("threaded mode needs the total_pages option")
            start, last, first = 1, int(self.total), None
        else:
            first = self._fetch(1, tp.Limiter(self.quota))
            start, last = 2, int(json.loads(first["payload"])["total_pages"])
        step = max(1, -(-max(last - start + 1, 0) // self.partition_count))
        parts = [PagePartition(p, min(p + step, last + 1)) for p in range(start, last + 1, step)]
        if first is not None:
            parts.insert(0, PagePartition(0, 0, first))
        return parts or [PagePartition(0, 0)]

    def _pages(self, pages: range):
        """Rows of the pages in their order; async and threaded modes keep at most ``in_flight`` requests open."""
        limiter = tp.Limiter(self.quota)
        if self.mode == "sequential" or self.in_flight == 1 or len(pages) < 2:
            yield from (self._fetch(p, limiter) for p in pages)
            return
        with ThreadPoolExecutor(min(self.in_flight, len(pages))) as pool:
            waiting = deque()
            for p in pages:
                waiting.append(pool.submit(self._fetch, p, limiter))
                if len(waiting) == self.in_flight:
                    yield waiting.popleft().result()
            while waiting:
                yield waiting.popleft().result()

    def read(self, partition: PagePartition):
        rows = self._pages(range(partition.start, partition.stop))
        for r in [partition.first] if partition.first is not None else rows:
            if r is not None:
                yield (r["page"], r["http_status"], r["status"], r["attempts"], r["error"], r["payload"])


class RestJsonDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "rest_json"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return RestJsonReader(dict(self.options))


def register(spark) -> None:
    spark.dataSource.register(RestJsonDataSource)


def explode_page_records(pages: DataFrame, fields: dict[str, str] | None = None) -> DataFrame:
    """Page rows -> one row per record (``_rec`` VARIANT, or typed fields ``{name: 'path:type'}``)."""
    recs = pages.where(F.col("status") == "ok").select(
        "page", F.posexplode(F.try_variant_get(F.try_parse_json("payload"), "$.records", "array<variant>"))
        .alias("pos", "_rec"))
    if not fields:
        return recs
    cols: list[Column] = []
    for name, spec in fields.items():
        path, dtype = spec.split(":")
        cols.append(F.variant_get("_rec", "$." + path, dtype).alias(name))
    return recs.select("page", "pos", *cols)
