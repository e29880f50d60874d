import pytest
from pyspark.sql import functions as F

from tamarack.functions import urls as U


def column(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, u string")
    return [r[0] for r in df.select("i", f(F.col("u")).alias("r")).orderBy("i").select("r").collect()]


def test_unsafe(spark):
    bad = [
        "http://169.254.169.254/latest/meta-data", "http://localhost:8080/", "http://127.0.0.1/", "http://10.0.0.1/x", "http://172.16.5.4", "http://192.168.0.10/", "file:///etc/passwd", "ftp://h.example/f",
        "javascript:alert(1)", "", None, "https://h.example/" + "a" * 3000, "http://[::1]/", "http://[fd00::1]/", "http://[fe80::1]/", "http://[::ffff:127.0.0.1]/", "http://metadata.google.internal/", "http:///nohost",
    ]
    assert not any(column(spark, bad, U.is_safe))
    good = ["https://h.example/a", "http://8.8.8.8/", "http://172.32.0.1/", "https://[2001:db8::1]/", "HTTPS://H.EXAMPLE/A"]
    assert all(column(spark, good, U.is_safe))


def test_resolver_fails_closed(spark):
    private = lambda h: h != F.lit("inside.example")
    got = column(spark, ["https://inside.example/", "https://out.example/"], lambda u: U.is_safe(u, resolver=private))
    assert got == [False, True]


def test_sanitize(spark):
    assert column(spark, [" h.example/a ", "http://10.0.0.1", "", "https://h.example"], U.sanitize) == ["https://h.example/a", "", "", "https://h.example"]


@pytest.mark.parametrize(
    ("url", "kind"),
    [
        ("https://www.komatsu.com/en/x", "manufacturer"), ("https://shop.cat.com/a.pdf", "manufacturer"), ("https://h.example/b.PDF", "pdf_brochure"), ("https://www.ritchiespecs.com/m", "spec_database"),
        ("https://www.mining.com/n", "industry_publication"), ("https://used-machines.example/", "dealer"), ("https://h.example/parts/1", "dealer"), ("https://h.example/x", "generic"), ("", "generic"), (None, "generic"), ("https://cat.com:443/", "generic"),
    ],
)
def test_classes(spark, url, kind):
    assert column(spark, [url], U.classify_source) == [kind]


def test_confidence(spark):
    u = ["https://www.cat.com/x", "https://h.example/x.pdf", "https://mascus.com/", "https://mining.com/", "https://h.example/dealer", "https://h.example/x"]
    assert column(spark, u, lambda c: U.source_confidence(0.8, c)) == [0.88, 0.86, 0.84, 0.82, 0.78, 0.72]
    assert column(spark, u, lambda c: U.source_confidence(0.9, c, True)) == [0.99, 0.97, 0.95, 0.93, 0.89, 0.83]
    assert column(spark, u[:1], lambda c: U.source_confidence(1.5, c, True)) == [1.0]


def test_blocked(spark):
    assert column(spark, ["https://www.youtube.com/v", "https://x.com/a", "https://max.com/a", None], U.is_blocked) == [True, True, False, True]
