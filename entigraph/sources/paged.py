"""Paged lists as a data source: one partition for each page where an answer tells how many there are.

The first page is read when Spark plans the scan and travels with its partition. If it tells the end, every other page is
a partition of its own, read and tried again by whichever executor has it; if it does not, the rest is one partition that
reads on until a page is short. A page that cannot be read ends the query.
"""

from __future__ import annotations

import base64
import json
import time
from collections.abc import Iterator
from typing import NamedTuple
from urllib.error import HTTPError

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .web import DOCUMENT_BYTES, Answer, Fetch, read_url

PAGE = "at long, url string, body binary"
#: Answers that another try does not change.
REFUSED = frozenset([400, 401, 403, 404, 410, 429])


class Paging(NamedTuple):
    """Where a list's pages are. `address` has braces for a page's position: that of its first item (`by_item`), or its own."""

    address: str
    first: int = 0
    by_item: bool = True
    size: int = 100  # items of a full page
    totals: tuple[str, ...] = ()  # keys under which an answer tells the number of items, or of pages
    pages: int | None = None  # pages that are wanted at most
    most: int | None = None  # items or pages beyond which the list is refused

    def url(self, at: int) -> str:
        return self.address.format(at)

    def total(self, text: str) -> int:
        data = json.loads(text)
        told = [str(data.get(k)) for k in self.totals] if isinstance(data, dict) else []
        return next((int(x) for x in told if x.isdigit()), 0)

    def positions(self, text: str) -> list[int] | None:
        """The positions of the pages behind the first, given its answer; None if only reading on will tell."""
        n, total = items(text), self.total(text)
        if self.most is not None and total > self.most:
            raise ValueError(f"the list has more than {self.most} entries")
        step = n if self.by_item else 1
        if not n or self.pages == 1:
            return []
        if not total:
            return None if self.by_item and n % self.size == 0 else []
        found = range(self.first + step, self.first + total, step)
        return list(found if self.pages is None else found[: self.pages - 1])


def items(text: str) -> int:
    """Length of the longest list of an answer, at most two keys deep."""
    level, longest = [json.loads(text)], 0
    for _ in range(3):
        longest = max([longest, *(len(x) for x in level if isinstance(x, list))])
        level = [v for x in level if isinstance(x, dict) for v in x.values()]
    return longest


class Page(InputPartition):
    def __init__(self, at: int, body: bytes | None = None, onward: bool = False):
        super().__init__(at)
        self.at, self.body, self.onward = at, body, onward


class PagedReader(DataSourceReader):
    def __init__(self, paging: Paging, fetch: Fetch, tries: int, wait: float):
        self.paging, self.fetch, self.tries, self.wait = paging, fetch, tries, wait

    def _body(self, at: int) -> bytes:
        for left in reversed(range(self.tries)):
            try:
                return Answer(*self.fetch(self.paging.url(at), max_bytes=DOCUMENT_BYTES)).body
            except Exception as e:
                if not left or isinstance(e, HTTPError) and e.code in REFUSED:
                    raise
                time.sleep(self.wait)
        raise AssertionError("no tries")

    def partitions(self) -> list[Page]:
        first = self.paging.first
        body = self._body(first)
        text = body.decode("utf-8-sig", "replace")
        more = self.paging.positions(text)
        rest = [Page(first + items(text), onward=True)] if more is None else [Page(at) for at in more]
        return [Page(first, body), *rest]

    def read(self, partition: Page) -> Iterator[tuple[int, str, bytes]]:
        at, paging = partition.at, self.paging
        while True:
            if paging.most is not None and at - paging.first > paging.most:
                raise ValueError(f"the list has more than {paging.most} entries")
            body = partition.body or self._body(at)
            yield at, paging.url(at), body
            n = items(body.decode("utf-8-sig", "replace")) if partition.onward else 0
            if not n or n % paging.size:
                return
            at += n


class PagedSource(DataSource):
    """format("entigraph_pages") with the option `spec`, see `pages`."""

    @classmethod
    def name(cls) -> str:
        return "entigraph_pages"

    def schema(self) -> str:
        return PAGE

    def reader(self, schema) -> PagedReader:
        return PagedReader(*cloudpickle.loads(base64.b64decode(self.options["spec"])))


def pages(spark: SparkSession, paging: Paging, fetch: Fetch = read_url, tries: int = 3, wait: float = 1.0) -> DataFrame:
    """(at, url, body) of a paged list; `at` is the page's position. Write it before use: each reading fetches again."""
    spark.dataSource.register(PagedSource)
    spec = base64.b64encode(cloudpickle.dumps((paging, fetch, tries, wait))).decode()
    return spark.read.format(PagedSource.name()).option("spec", spec).load()
