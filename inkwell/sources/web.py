"""Pages fetched over HTTP as a batch data source, with retry rules; and windows of pages by sequence number.

``spark.dataSource.register(PageSource)`` once, then ``spark.read.format("inkwell_pages").option("urls", <JSON list>)``. The
transport is a function ``module:name`` of (url, timeout) that gives status, headers and body, by default the standard
library's; tests name their own. Urls of one host are one partition, so that a host is asked by one task at a time.
"""

from __future__ import annotations

import importlib
import json
import re
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

Transport = Callable[[str, float], tuple[int, dict[str, str], bytes]]
#: Statuses that are tried again, and the words for tries that came to nothing.
RETRIED = {429, 500, 502, 503, 504}
EXHAUSTED = "max_retries_exceeded"


def http(url: str, timeout: float) -> tuple[int, dict[str, str], bytes]:
    """Status, headers (lower case) and body of a GET."""
    try:
        with urllib.request.urlopen(url, timeout=timeout) as r:
            return r.status, {k.lower(): v for k, v in r.headers.items()}, r.read()
    except urllib.error.HTTPError as e:
        return e.code, {}, b""


def decoded(headers: dict[str, str], body: bytes) -> str:
    """The body as text: by the declared charset, which for Latin-1 or none is doubted when the bytes are UTF-8."""
    declared = re.search(r"charset=[\"']?([\w-]+)", headers.get("content-type", ""), re.I)
    name = declared[1].lower() if declared else ""
    if name in ("", "iso-8859-1", "latin-1"):
        try:
            return body.decode("utf-8")
        except UnicodeDecodeError:
            return body.decode("windows-1252", "replace")
    try:
        return body.decode(name, "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def fetched(url: str, transport: Transport, tries: int = 3, wait: float = 2.0, timeout: float = 30.0, sleep: Callable[[float], None] = time.sleep) -> tuple[int, str, int]:
    """Status, text and tries of a url. Busy servers and broken connections are tried again after doubled waits; a missing
    page has no text; when no try served, the status is 0 and the text says so."""
    for k in range(tries):
        try:
            status, headers, body = transport(url, timeout)
        except OSError:
            status, headers, body = 0, {}, b""
        if status == 200:
            return status, decoded(headers, body), k + 1
        if status and status not in RETRIED:
            return status, "", k + 1
        if k + 1 < tries:
            sleep(wait * 2**k)
    return 0, EXHAUSTED, tries


def _named(path: str) -> Transport:
    module, name = path.split(":")
    return getattr(importlib.import_module(module), name)


class _Urls(InputPartition):
    def __init__(self, urls: list[str]):
        super().__init__(urls)
        self.urls = urls


class PageReader(DataSourceReader):
    """Fetches the urls of a host one after the other."""

    def __init__(self, options: dict):
        self.urls = json.loads(options.get("urls", "[]"))
        self.transport = options.get("transport", f"{__name__}:http")
        self.tries, self.delay, self.wait = int(options.get("tries", 3)), float(options.get("delay", 1.5)), float(options.get("wait", 2))

    def partitions(self) -> list[InputPartition]:
        by_host: dict[str, list[str]] = {}
        for u in dict.fromkeys(self.urls):
            by_host.setdefault(urlsplit(u).netloc, []).append(u)
        return [_Urls(v) for _, v in sorted(by_host.items())]

    def read(self, partition: _Urls) -> Iterator[tuple]:
        transport = _named(self.transport)
        for k, url in enumerate(partition.urls):
            if k:
                time.sleep(self.delay)
            status, text, tries = fetched(url, transport, self.tries, self.wait)
            yield url, status, text, tries


class PageSource(DataSource):
    """Options: urls (a JSON list), transport, tries (1 for a single try), delay and wait in seconds."""

    @classmethod
    def name(cls) -> str:
        return "inkwell_pages"

    def schema(self) -> str:
        return "url string, status int, html string, tries int"

    def reader(self, schema) -> DataSourceReader:
        return PageReader(self.options)


class WindowReader(DataSourceReader):
    """Walks the windows of a stretch of sequence numbers, as each says where the next begins."""

    def __init__(self, options: dict):
        self.base, self.transport = options["base"], options.get("transport", f"{__name__}:http")
        self.first, self.last = int(options.get("first", 1)), int(options["last"])
        self.stretch, self.step = int(options.get("stretch", 500)), int(options.get("step", 20))
        self.failures, self.delay = int(options.get("failures", 3)), float(options.get("delay", 1.5))
        self.start = options.get("startDate", "")

    def partitions(self) -> list[InputPartition]:
        if self.start:
            # the source itself tells at which number a day begins
            from inkwell.operators.pages import window_bounds

            status, text, _ = fetched(f"{self.base}?date={self.start}", _named(self.transport), 1)
            self.first = max(self.first, window_bounds(text)[0]) if status == 200 else self.first
        return [InputPartition((a, min(a + self.stretch - 1, self.last))) for a in range(self.first, self.last + 1, self.stretch)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        from inkwell.operators.pages import window_bounds

        transport, (at, last), failed = _named(self.transport), partition.value, 0
        while at <= last and failed < self.failures:
            url = f"{self.base}?seq={at}"
            status, text, tries = fetched(url, transport, 1)
            failed = 0 if status == 200 else failed + 1
            upto = window_bounds(text)[1] if status == 200 else 0
            if status == 200:
                yield url, status, text, tries
            at = upto + 1 if upto >= at else at + self.step
            time.sleep(self.delay)


class WindowSource(DataSource):
    """Windows of pages: options base, last, first, startDate, stretch (numbers a partition), step, failures, delay, transport."""

    @classmethod
    def name(cls) -> str:
        return "inkwell_windows"

    def schema(self) -> str:
        return "url string, status int, html string, tries int"

    def reader(self, schema) -> DataSourceReader:
        return WindowReader(self.options)


def register(spark) -> None:
    """Makes both sources known to the session."""
    spark.dataSource.register(PageSource)
    spark.dataSource.register(WindowSource)
