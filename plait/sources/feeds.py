"""RSS and Atom feeds as a Spark data source: one partition for each feed, alternates tried in order.

``spark.dataSource.register(FeedSource)``, then ``spark.read.format("plait_feed").option("feeds", json).load()``, where json lists
objects with source_id, url and alternates.  The transport is a module path ``package.module:function`` (option ``transport``) of a
function from URL to bytes; the default reads http(s) with retries.  Tests pass one that reads fixtures.
"""

from __future__ import annotations

import importlib
import json
import re
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.text import BARE_AMPERSAND, XML_FORBIDS

SCHEMA = (
    "source_id string, used_url string, pos int, link string, links array<struct<href: string, type: string>>, title string, summary string, published string, updated string, "
    "media_content array<string>, media_thumbnail array<string>, enclosures array<struct<href: string, type: string>>, author string, error string"
)
_ILLEGAL, _BARE = re.compile(XML_FORBIDS.encode()), re.compile(BARE_AMPERSAND.encode())


def clean_bytes(raw: bytes) -> bytes:
    """Without bytes that XML forbids, bare ampersands escaped."""
    return _BARE.sub(b"&amp;", _ILLEGAL.sub(b"", raw))


def open_url(url: str, tries: int = 3, timeout: float = 20.0) -> tuple[str, bytes]:
    """(final URL, body) at a URL.  429, 5xx and transport errors are tried again after growing pauses, other errors are final."""
    for n in range(1, tries + 1):
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": "plait/1"}), timeout=timeout) as response:
                return response.geturl(), response.read()
        except urllib.error.HTTPError as error:
            if n == tries or not (error.code == 429 or error.code >= 500):
                raise
            time.sleep(1.5 * n)
        except OSError:
            if n == tries:
                raise
            time.sleep(1.0 * n)
    raise AssertionError


def fetch(url: str) -> bytes:
    return open_url(url)[1]


def named(path: str) -> Callable:
    """The function that ``package.module:function`` names."""
    module, name = path.split(":")
    return getattr(importlib.import_module(module), name)


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1].lower()


def _items(raw: bytes) -> list[ElementTree.Element]:
    try:
        root = ElementTree.fromstring(raw)
    except ElementTree.ParseError:
        root = ElementTree.fromstring(clean_bytes(raw))
    return [x for x in root.iter() if _local(x.tag) in ("item", "entry")]


def parse_items(raw: bytes) -> list[dict]:
    """The items of a feed with their fields as they stand; malformed bytes are cleaned and parsed again."""
    out = []
    for item in _items(raw):
        row = {"link": None, "links": [], "title": None, "summary": None, "published": None, "updated": None, "media_content": [], "media_thumbnail": [], "enclosures": [], "author": None}
        for x in item:
            name, text, space = _local(x.tag), "".join(x.itertext()).strip(), x.tag.rsplit("}", 1)[0]
            media = "search.yahoo.com/mrss" in space
            if name == "link":
                href = x.get("href") or text
                row["links"].append({"href": href, "type": x.get("type")})
                if text or x.get("rel") in (None, "alternate"):
                    row["link"] = row["link"] or href
            elif name in ("title", "author", "creator") and not media:
                key = "title" if name == "title" else "author"
                row[key] = row[key] or text or None
            elif name in ("description", "summary") and not media:
                row["summary"] = row["summary"] or text or None
            elif name in ("pubdate", "published", "date"):
                row["published"] = row["published"] or text or None
            elif name == "updated":
                row["updated"] = text or None
            elif name == "enclosure":
                row["enclosures"].append({"href": x.get("url"), "type": x.get("type")})
            elif media and name in ("content", "thumbnail") and x.get("url"):
                row[f"media_{name}"].append(x.get("url"))
        out.append(row)
    return out


def read_feed(url: str, alternates: list[str], transport: Callable[[str], bytes]) -> tuple[str | None, list[dict], str | None]:
    """(URL that worked, items, error) of the first URL that gives items."""
    errors = []
    for one in [url, *alternates]:
        try:
            items = parse_items(transport(one))
            if items:
                return one, items, None
            errors.append(f"{one}: no items")
        except Exception as error:  # noqa: BLE001  a feed may fail in any way; the others go on
            errors.append(f"{one}: {error}")
    return None, [], "; ".join(errors)[:1000]


class _Feed(InputPartition):
    def __init__(self, source_id: str, url: str, alternates: list[str]):
        self.source_id, self.url, self.alternates = source_id, url, alternates


class FeedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.feeds = json.loads(options.get("feeds", "[]"))
        self.transport = options.get("transport", "plait.sources.feeds:fetch")

    def partitions(self):
        return [_Feed(f["source_id"], f["url"], list(f.get("alternates") or [])) for f in self.feeds]

    def read(self, partition: _Feed) -> Iterator[tuple]:
        used, items, error = read_feed(partition.url, partition.alternates, named(self.transport))
        if error:
            yield (partition.source_id, None, None, None, [], None, None, None, None, [], [], [], None, error)
        pair = lambda xs: [(x["href"], x["type"]) for x in xs]
        for pos, r in enumerate(items):
            yield (partition.source_id, used, pos, r["link"], pair(r["links"]), r["title"], r["summary"], r["published"], r["updated"], r["media_content"], r["media_thumbnail"], pair(r["enclosures"]), r["author"], None)


class FeedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "plait_feed"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FeedReader:
        return FeedReader(self.options)
