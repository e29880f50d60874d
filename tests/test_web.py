import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from tamarack.functions import rules as R
from tamarack.functions import urls
from tamarack.sources import web


def test_private_addresses_against_the_library(spark):
    rng = random.Random(1)
    groups = lambda n: ":".join(f"{rng.randrange(1 << 16):x}" for _ in range(n))
    texts = ["::1", "0:0:0:0:0:0:0:1", "::", "::2", "2001:db8::1", "fe7f::1", "fec0::1", "fbff::1", "fe00::1", "::ffff:192.168.1.1", "::ffff:192.169.1.1", "::ffff:c0a8:101", "::ffff:808:808", "fe80::1%25eth0"]
    texts += [f"{p}{groups(2)[4:] or ':1'}" for p in ("fc", "fd")] + [groups(8) for _ in range(40)] + [f"{x:x}::{rng.randrange(9)}" for x in range(0xFB00, 0xFFFF, 97)]
    nets = [ipaddress.ip_network(n) for n in (*R.PRIVATE_V6, *R.PRIVATE_V4)]

    def private(t):
        try:
            ip = ipaddress.ip_address(t.split("%")[0])
        except ValueError:
            return None
        ip = getattr(ip, "ipv4_mapped", None) or ip
        return any(ip.version == n.version and ip in n for n in nets)

    got = {r.t: r.p for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", urls.is_private_ip(F.col("t")).alias("p")).collect()}
    for t in texts:
        want = private(t)
        assert want is None or got[t] == want, t


def test_limit_slides():
    now = [0.0]
    limit = web.Limit(3, 10, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s))
    at = []
    for _ in range(7):
        limit()
        at.append(now[0])
        now[0] += 1
    assert at == [0, 1, 2, 10, 11, 12, 20]


def test_retries():
    calls, pauses = [], []

    def call():
        calls.append(1)
        if len(calls) == 1:
            raise OSError("down")
        return (503, "", b"") if len(calls) == 2 else (200, "text/html", b"x")

    assert web.tried(call, 3, pauses.append)[0] == 200 and pauses == [1, 2]
    with pytest.raises(OSError):
        web.tried(lambda: (_ for _ in ()).throw(OSError("down")), 2, pauses.append)


def make_get():
    def get(url, agent, timeout):
        if url.endswith("/robots.txt"):
            return (200, "text/plain", b"User-agent: *\nDisallow: /private") if "a.example" in url else (404, "", b"")
        if "down" in url:
            raise OSError("no route")
        if url.endswith(".pdf"):
            return 200, "application/pdf", b"%PDF-1.4 x" if "good" in url else b"<html>"
        if "gone" in url:
            return 404, "", b""
        if "zip" in url:
            return 200, "application/zip", b"PK"
        return 200, "text/html; charset=utf-8", ("<p>é</p>" if "big" not in url else "x" * (web.MAX_PAGE + 1)).encode()

    return get  # nested, so that tasks get it by value


def test_fetch(spark):
    us = ["https://a.example/1", "https://a.example/1", "https://a.example/private/x", "http://10.0.0.1/", "http://[::1]/", None, "", "https://b.example/down", "https://b.example/good.pdf", "https://b.example/bad.pdf", "https://b.example/gone", "https://b.example/zip", "https://b.example/big"]
    df = spark.createDataFrame([(u, "x") for u in us], "url string, html string")
    got = {r.url: r for r in web.fetch(df, make_get(), delay=0).collect()}
    assert set(got) == set(us) - {"http://10.0.0.1/", "http://[::1]/", None, ""}
    assert got["https://a.example/1"].html == "<p>é</p>" and got["https://a.example/1"].error is None
    assert got["https://a.example/private/x"].error == "forbidden by robots" and got["https://b.example/down"].error == "no route"
    assert bytes(got["https://b.example/good.pdf"].pdf).startswith(b"%PDF") and got["https://b.example/bad.pdf"].pdf is None
    assert [got[f"https://b.example/{x}"].error for x in ("gone", "zip", "big")] == ["status 404", "neither a page nor a document", "too large"]
    assert web.fetch(df.where("false"), make_get(), delay=0).count() == 0
