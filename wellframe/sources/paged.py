"""Web services as data sources: numbered pages, offsets, next links and batches of ids, one task per stretch.

    spark.dataSource.register(PagedJson)
    spark.read.format("paged_json").options(url=..., paging=..., ...).load()

``paging`` says how a service cuts its answers:

- ``page``: ``{page}`` in the url runs from ``first`` (0) to ``pages`` - 1; ``pagesPerTask`` pages a task.
- ``offset``: ``{offset}`` in the url runs to ``total`` in steps of ``limit``; as many tasks as there are steps / ``pagesPerTask``.
- ``next``: each answer names the next one, by a link of relation ``next`` or a member ``@iot.nextLink``. Answers
  follow one another, so a url is one task; several urls (separated by blanks) are several.
- ``ids``: ``ids`` (separated by commas) in batches of ``batch``; a batch is put into the url or the body as
  ``{ids}`` (quoted, separated by commas) and is one task; its answers may have next links.

``selector`` names the member that holds the rows; ``method``, ``body`` and ``header.<name>`` make the request;
``top`` takes the first answer only. A service that is too busy (429) is asked again after the time it names.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class SourceUnavailable(RuntimeError):
    """The service gave no usable answer after all tries."""


class RateLimited(SourceUnavailable):
    """The service still asked to wait after all tries."""


@dataclass(frozen=True)
class Request:
    """How to ask: timeout in seconds, tries, first wait, method, headers."""

    timeout: float = 900.0
    tries: int = 4
    wait: float = 1.0
    method: str = "GET"
    headers: tuple[tuple[str, str], ...] = ()


def fetch_text(url: str, params: dict[str, str] | None = None, body: str | None = None, how: Request = Request(timeout=30.0)) -> str:
    """The answer's text. Raises RateLimited or SourceUnavailable after the last try; other client errors at once."""
    if params:
        url += ("&" if "?" in url else "?") + urllib.parse.urlencode(params)
    for attempt in range(how.tries):
        last = attempt + 1 == how.tries
        try:
            request = urllib.request.Request(url, data=None if body is None else body.encode(), headers=dict(how.headers), method=how.method)
            with urllib.request.urlopen(request, timeout=how.timeout) as got:
                return got.read().decode("utf-8", "replace")
        except urllib.error.HTTPError as error:
            if error.code == 429:
                if last:
                    raise RateLimited(f"{url}: too many requests") from error
                time.sleep(float(error.headers.get("Retry-After") or how.wait * 2**attempt))
            elif error.code < 500 or last:
                raise SourceUnavailable(f"{url}: {error.code}") from error
            else:
                time.sleep(how.wait * 2**attempt)
        except (urllib.error.URLError, TimeoutError, ConnectionError) as error:
            if last:
                raise SourceUnavailable(f"{url}: {error}") from error
            time.sleep(how.wait * 2**attempt)
    raise SourceUnavailable(url)


def fetch_json(url: str, params: dict[str, str] | None = None, selector: str = "", body: str | None = None, how: Request = Request()) -> object:
    """The answer, or its member ``selector``."""
    text = fetch_text(url, params, body, how)
    try:
        got = json.loads(text)
    except ValueError as error:
        raise SourceUnavailable(f"{url}: no JSON") from error
    return got.get(selector, []) if selector and isinstance(got, dict) else got


def next_link(answer: object) -> str | None:
    """The address of the following answer, if this one names it."""
    if not isinstance(answer, dict):
        return None
    if answer.get("@iot.nextLink"):
        return answer["@iot.nextLink"]
    return next((x.get("href") for x in answer.get("links") or [] if isinstance(x, dict) and x.get("rel") == "next"), None)


class Stretch(InputPartition):
    """Requests of one task: (number, url, body), and whether to follow next links."""

    def __init__(self, requests: list[tuple[int, str, str | None]], follow: bool):
        self.requests, self.follow = requests, follow


class PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)
        get = self.options.get
        self.selector, self.top = get("selector", ""), str(get("top", "false")).lower() == "true"
        headers = tuple((k[7:], v) for k, v in self.options.items() if k.startswith("header."))
        if get("body") and not any(k.lower() == "content-type" for k, _ in headers):
            headers += (("Content-Type", "application/json"),)
        self.how = Request(float(get("timeout", 900)), int(get("tries", 4)), float(get("wait", 1)), get("method", "POST" if get("body") else "GET"), headers)

    def partitions(self) -> list[Stretch]:
        get = self.options.get
        url, body, paging, per_task = self.options["url"], get("body"), get("paging", "page"), int(get("pagesPerTask", 10))
        fill = lambda text, name, value: None if text is None else text.replace("{" + name + "}", str(value))
        if paging == "next":
            return [Stretch([(i, u, body)], not self.top) for i, u in enumerate(url.split())]
        if paging == "ids":
            ids = [x.strip() for x in get("ids", "").split(",") if x.strip()]
            size = int(get("batch", 250))
            batches = [",".join("'" + x.replace("'", "''") + "'" for x in ids[a : a + size]) for a in range(0, len(ids), size)]
            return [Stretch([(i, fill(url, "ids", urllib.parse.quote(b)), fill(body, "ids", b))], not self.top) for i, b in enumerate(batches)]
        if paging == "offset":
            limit = int(get("limit", 2000))
            steps = [(i, fill(url, "offset", a).replace("{limit}", str(limit)), body) for i, a in enumerate(range(0, int(get("total", 0)), limit))]
        else:
            first = int(get("first", 0))
            steps = [(n, fill(url, "page", n), fill(body, "page", n)) for n in range(first, first + int(get("pages", 1)))]
        return [Stretch(steps[a : a + per_task], False) for a in range(0, len(steps), per_task)]

    def read(self, partition: Stretch) -> Iterator[tuple]:
        for number, url, body in partition.requests:
            while url:
                answer = fetch_json(url, body=body, how=self.how)
                rows = answer.get(self.selector, []) if self.selector and isinstance(answer, dict) else answer
                for row in rows if isinstance(rows, list) else [rows]:
                    yield (number, json.dumps(row))
                # a next link is asked with the same body where the service is posted to
                url = next_link(answer) if partition.follow else None


class PagedJson(DataSource):
    """Rows (page, row): the request's number and one row as JSON text."""

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return "page int, row string"

    def reader(self, schema) -> PagedReader:
        return PagedReader(self.options)


def healthy(url: str, how: Request = Request(timeout=30.0, tries=1)) -> bool:
    """Whether the service answers."""
    try:
        return bool(fetch_text(url, how=how))
    except SourceUnavailable:
        return False


def sensorthings_url(base: str, path: str, expand: str | None = None, filter: str | None = None, top: int | None = None, orderby: str | None = None) -> str:
    """Address of a SensorThings collection."""
    wanted = {"$expand": expand, "$filter": filter, "$top": top, "$orderby": orderby}
    query = urllib.parse.urlencode({k: v for k, v in wanted.items() if v is not None}, safe="$,/()'")
    return f"{base.rstrip('/')}/{path}" + (f"?{query}" if query else "")


def during(column: str, start: str | None, end: str | None) -> str | None:
    """Filter text of a time range, either end open."""
    parts = [f"{column} ge {start}" if start else "", f"{column} le {end}" if end else ""]
    return " and ".join(p for p in parts if p) or None
