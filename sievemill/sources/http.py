"""Pages over HTTP as a Python data source: retries with backoff, and a pause between requests."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def fetch(url: str, get: Callable[[str], str], retries: int = 3, sleep: Callable[[float], None] = time.sleep) -> str | None:
    """The page, or null after the last try; 1, 2, 4... seconds between tries."""
    for attempt in range(retries):
        try:
            return get(url)
        except Exception:
            if attempt < retries - 1:
                sleep(2.0**attempt)
    return None


class RateLimiter:
    """At least `delay` seconds between the starts of requests."""

    def __init__(self, delay: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.delay, self.clock, self.sleep = delay, clock, sleep
        self.last: float | None = None

    def wait(self) -> None:
        if self.last is not None and (left := self.delay - (self.clock() - self.last)) > 0:
            self.sleep(left)
        self.last = self.clock()


def _get(timeout: float, agent: str) -> Callable[[str], str]:
    from urllib.request import Request, urlopen

    def get(url: str) -> str:
        headers = {"User-Agent": agent, "Accept": "text/html,application/xhtml+xml,application/xml;q=0.9,*/*;q=0.8", "Accept-Language": "en-US,en;q=0.5"}
        with urlopen(Request(url, headers=headers), timeout=timeout) as r:  # raises for statuses of 400 and more
            return r.read().decode(r.headers.get_content_charset() or "utf-8", "replace")

    return get


class _Urls(InputPartition):
    def __init__(self, first: int, urls: list[str]):
        self.first, self.urls = first, urls


class PageReader(DataSourceReader):
    """One partition a host, so that the pause holds for each host."""

    def __init__(self, options: dict[str, str]):
        self.urls = [u for u in options.get("urls", "").split("\n") if u]
        self.delay, self.timeout = float(options.get("delay", "1")), float(options.get("timeout", "30"))
        self.retries, self.agent = int(options.get("retries", "3")), options.get("agent", "sievemill/1.0")

    def partitions(self) -> list[InputPartition]:
        hosts: dict[str, list[tuple[int, str]]] = {}
        for i, u in enumerate(self.urls):
            hosts.setdefault("/".join(u.split("/")[:3]), []).append((i, u))
        return [_Urls(0, [f"{i} {u}" for i, u in group]) for group in hosts.values()]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        limiter, get = RateLimiter(self.delay), _get(self.timeout, self.agent)

        def paced(url: str) -> str:
            limiter.wait()
            return get(url)

        for item in partition.urls:  # type: ignore[attr-defined]
            number, url = item.split(" ", 1)
            yield int(number), url, fetch(url, paced, self.retries)


class PageSource(DataSource):
    """spark.read.format("pages").option("urls", "one a line").load() -> ord, url, html (null if it could not be fetched)."""

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return "ord long, url string, html string"

    def reader(self, schema) -> DataSourceReader:
        return PageReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PageSource)
