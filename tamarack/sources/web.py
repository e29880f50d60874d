"""Fetching pages: safety, robots, a limit per host, retries, and what a response may be.

Addresses are laid out by host, so that a host is one task's and its limit holds across the
cluster without a shared counter; robots files are read once per host and task. The
function that makes a call is given, so tests and closed networks need no connection.
"""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit
from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import urls
from .files import MAX_PAGE, MAX_PDF

#: A call: address, agent and seconds to (status, content type, body). OSError means that it may be tried again.
Get = Callable[[str, str, float], tuple[int, str, bytes]]
FETCHED = "url string, status int, content_type string, html string, pdf binary, error string"


class Limit:
    """At most ``calls`` in any ``seconds``: waits until the oldest of the last ones is that old."""

    def __init__(self, calls: int = 20, seconds: float = 60.0, clock=time.monotonic, sleep=time.sleep):
        self.calls, self.seconds, self.clock, self.sleep = calls, seconds, clock, sleep
        self.made: deque[float] = deque()

    def __call__(self) -> None:
        now = self.clock()
        while self.made and self.made[0] <= now - self.seconds:
            self.made.popleft()
        if len(self.made) >= self.calls:
            self.sleep(self.made[0] + self.seconds - now)
            self.made.popleft()
        self.made.append(self.clock())


def http_get(url: str, agent: str, timeout: float) -> tuple[int, str, bytes]:
    """One call; no more than the largest document is read, and redirects aren't followed to hosts that weren't checked."""
    import urllib.request

    class Stay(urllib.request.HTTPRedirectHandler):
        def redirect_request(self, req, fp, code, msg, headers, newurl):
            same = urlsplit(newurl).hostname == urlsplit(req.full_url).hostname
            return super().redirect_request(req, fp, code, msg, headers, newurl) if same else None

    request = urllib.request.Request(url, headers={"User-Agent": agent})
    try:
        with urllib.request.build_opener(Stay).open(request, timeout=timeout) as r:
            return r.status, r.headers.get("Content-Type", ""), r.read(MAX_PDF + 1)
    except urllib.error.HTTPError as e:
        return e.code, "", b""


def tried(call: Callable[[], tuple[int, str, bytes]], retries: int, sleep=time.sleep) -> tuple[int, str, bytes]:
    """The call, repeated after growing pauses of at most ten seconds while it fails or the server does."""
    for attempt in range(retries + 1):
        try:
            status, kind, body = call()
            if status < 500 or attempt == retries:
                return status, kind, body
        except OSError:
            if attempt == retries:
                raise
        sleep(min(10, 2**attempt))
    raise OSError("not reached")


def _row(url: str, status: int, kind: str, body: bytes) -> tuple:
    if status != 200:
        return url, status, kind, None, None, f"status {status}"
    pdf = "application/pdf" in kind.lower() or (not kind and urlsplit(url).path.lower().endswith(".pdf"))
    if pdf:
        ok = len(body) <= MAX_PDF and body[:5] == b"%PDF-"
        return url, status, kind, None, body if ok else None, None if ok else "not a document, or too large"
    if kind and not any(t in kind.lower() for t in ("text/html", "application/xhtml", "text/plain")):
        return url, status, kind, None, None, "neither a page nor a document"
    if len(body) > MAX_PAGE:
        return url, status, kind, None, None, "too large"
    return url, status, kind, body.decode("utf-8", "replace"), None, None


def fetch(pages: DataFrame, get: Get = http_get, agent: str = "tamarack", delay: float = 2.0, timeout: float = 30.0, retries: int = 3, robots: bool = True, calls: int = 20, seconds: float = 60.0) -> DataFrame:
    """pages(url, ...) to (url, status, content_type, html, pdf, error), a row per different safe address.

    Unsafe addresses aren't called and have no row. What robots forbid, failed calls and
    responses that are too large or no page have their error and null content. A host is
    called at most ``calls`` times in ``seconds``, with ``delay`` between calls.
    """
    todo = pages.select("url").where(urls.is_safe(F.col("url"))).distinct().withColumn("_host", urls.host(F.col("url")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        host, limit, rules = None, None, None
        for b in batches:
            rows = []
            for url, h in zip(b["url"], b["_host"]):
                if h != host:
                    host, limit, rules = h, Limit(calls, seconds), None
                    if robots:
                        rules = RobotFileParser()
                        parts = urlsplit(url)
                        try:
                            limit()
                            status, _, body = get(f"{parts.scheme}://{parts.netloc}/robots.txt", agent, timeout)
                            rules.parse(body.decode("utf-8", "replace").splitlines() if status == 200 else [])
                        except OSError:
                            rules.parse([])
                if rules is not None and not rules.can_fetch(agent, url):
                    rows.append((url, None, None, None, None, "forbidden by robots"))
                    continue
                try:
                    limit()
                    rows.append(_row(url, *tried(lambda u=url: get(u, agent, timeout), retries, time.sleep if delay else lambda _: None)))
                except OSError as e:
                    rows.append((url, None, None, None, None, str(e) or type(e).__name__))
                time.sleep(delay)
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in FETCHED.split(", ")])
            yield out.astype({"status": "Int32"})

    return todo.repartition("_host").sortWithinPartitions("_host", "url").mapInPandas(run, FETCHED)
