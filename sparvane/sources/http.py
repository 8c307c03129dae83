"""A paged HTTP source as a Python data source: one partition per page range.

The transport is passed in, so nothing here opens a connection by itself. With a ``query`` every page is asked for
by a GraphQL request, whose variables are the page and those given. An answer that is an object is one item, such as
a service's figures, unless ``items`` names the path to a list in it.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.flatten import sound

#: Transports by name: a function from URL (and a request's body, if there is one) to response text, registered by the caller.
TRANSPORTS: dict[str, Callable[..., str]] = {}


class _Pages(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


class PagedReader(DataSourceReader):
    def __init__(self, options: dict, transport: Callable[..., str]):
        self.options, self.transport = options, transport

    def partitions(self) -> list[InputPartition]:
        pages, size = int(self.options.get("pages", 1)), int(self.options.get("pagespartition", 10))
        return [_Pages(k, min(k + size, pages)) for k in range(0, pages, size)]

    def read(self, partition: _Pages) -> Iterator[tuple]:
        for page in range(partition.first, partition.last):
            url = self.options["url"].replace("{page}", str(page))
            for item in self._items(json.loads(self.transport(url, *self._body(page)))):
                yield page, sound(json.dumps(item, ensure_ascii=False))

    def _body(self, page: int) -> list[str]:
        if "query" not in self.options:
            return []
        variables = json.loads(self.options.get("variables", "{}")) | {"page": page}
        return [json.dumps({"query": self.options["query"], "variables": variables})]

    def _items(self, answer) -> list:
        if isinstance(answer, dict) and answer.get("errors"):
            raise RuntimeError(f"the service answered with errors: {answer['errors']}")
        for step in filter(None, self.options.get("items", "").split(".")):
            answer = answer[step]
        return answer if isinstance(answer, list) else [answer]


class PagedHttp(DataSource):
    """``spark.read.format("paged_http").option("url", "...{page}").option("pages", n).option("transport", name)``."""

    @classmethod
    def name(cls) -> str:
        return "paged_http"

    def schema(self) -> str:
        return "page int, item string"

    def reader(self, schema) -> DataSourceReader:
        name = self.options.get("transport", "")
        if name not in TRANSPORTS:
            raise ValueError("no transport is registered under that name")
        return PagedReader(dict(self.options), TRANSPORTS[name])
