"""Search engines as a batch data source: results as rows, queries that failed with their error.

An engine's queries are one partition, so that its limit (``calls`` in ``seconds``, 20 in 60
unless given) holds for all of them; several engines are several reads.

``spark.dataSource.register(SearchSource)``, then ``spark.read.format("search_api")`` with the
options queries (a JSON list), engine (google or serper), key, cx, num, pause and a fetcher
("module:function", which gets engine, query and options and gives the response as a dict),
so that tests and closed networks need no connection.
"""

from __future__ import annotations

import importlib
import json
import time

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "query string, seq int, title string, url string, snippet string, source_engine string, error string"


def results(engine: str, payload: dict) -> list[dict]:
    """Results of a response: items of one engine, organic of the other."""
    key, link = ("items", "link") if engine == "google" else ("organic", "link")
    return [{"title": r.get("title", ""), "url": r.get(link, ""), "snippet": r.get("snippet", "")} for r in payload.get(key) or []]


def http_fetch(engine: str, query: str, options: dict) -> dict:
    """One call, tried three times with growing pauses of at most ten seconds."""
    import urllib.parse
    import urllib.request

    n = int(options.get("num", 10))
    if engine == "google":
        args = {"key": options["key"], "cx": options["cx"], "q": query, "num": min(n, 10), "lr": f"lang_{options.get('language', 'en')}"}
        request = urllib.request.Request("https://www.googleapis.com/customsearch/v1?" + urllib.parse.urlencode(args))
    else:
        body = json.dumps({"q": query, "num": n, "hl": options.get("language", "en")}).encode()
        request = urllib.request.Request("https://google.serper.dev/search", body, {"X-API-KEY": options["key"], "Content-Type": "application/json"})
    for attempt in range(3):
        try:
            with urllib.request.urlopen(request, timeout=30) as r:
                return json.load(r)
        except OSError:
            if attempt == 2:
                raise
            time.sleep(min(10, 2**attempt))
    raise OSError("not reached")


class _Queries(InputPartition):
    def __init__(self, queries: list[str]):
        self.queries = queries


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self):
        return [_Queries(json.loads(self.options.get("queries", "[]")))]

    def read(self, partition):
        from .web import Limit

        engine = self.options.get("engine", "google")
        if "fetcher" not in self.options and not self.options.get("key"):
            return  # without a key an engine has no results
        fetch = http_fetch
        if "fetcher" in self.options:
            module, name = self.options["fetcher"].split(":")
            fetch = getattr(importlib.import_module(module), name)
        limit = Limit(int(self.options.get("calls", 20)), float(self.options.get("seconds", 60)))
        for query in partition.queries:
            limit()
            try:
                for i, r in enumerate(results(engine, fetch(engine, query, dict(self.options)))):
                    yield (query, i, r["title"], r["url"], r["snippet"], engine, None)
            except OSError as e:
                yield (query, None, None, None, None, engine, str(e) or type(e).__name__)
            time.sleep(float(self.options.get("pause", 0)))


class SearchSource(DataSource):
    @classmethod
    def name(cls):
        return "search_api"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options)
