"""Addresses: parts, safety, blocking, class and trust of a source, as column expressions."""

from __future__ import annotations

import ipaddress

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules as R


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*):(?://([^/?#]*))?([^?#]*)", group)


def scheme(url: Column) -> Column:
    return F.lower(_part(url, 1))


def authority(url: Column) -> Column:
    """Host with user name and port, in lower case; "" for addresses without one."""
    return F.lower(_part(url, 2))


def host(url: Column) -> Column:
    """Host alone, in lower case and without the brackets of an IPv6 address."""
    bare = F.regexp_replace(authority(url), r"^.*@", "")
    v6 = F.regexp_extract(bare, r"^\[([^\]]*)\]", 1)
    return F.when(bare.startswith("["), v6).otherwise(F.regexp_replace(bare, r":\d*$", ""))


def path(url: Column) -> Column:
    """Path in lower case without parameters of its last segment."""
    return F.regexp_replace(F.lower(_part(url, 3)), r";[^/]*$", "")


def in_domains(domain: Column, domains: tuple[str, ...]) -> Column:
    """Whether a domain or any domain above it is listed."""
    labels = F.split(domain, r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return F.arrays_overlap(above, F.array(*map(F.lit, domains)))


def classify_source(url: Column) -> Column:
    """manufacturer, pdf_brochure, spec_database, industry_publication, dealer or generic; null and "" are generic."""
    # one pass over the address: the struct's fields are computed once for all rules
    parts = F.transform(F.array(F.struct(authority(url).alias("a"), path(url).alias("p"))), lambda x: F.struct(F.regexp_replace(x["a"], r"^www\.", "").alias("d"), x["p"].alias("p")))

    def named(x: Column) -> Column:
        d, p = x["d"], x["p"]
        return (
            F.when(in_domains(d, R.MANUFACTURERS), "manufacturer")
            .when(p.endswith(".pdf"), "pdf_brochure")
            .when(in_domains(d, R.SPEC_DATABASES), "spec_database")
            .when(in_domains(d, R.PUBLICATIONS), "industry_publication")
            .when(d.rlike(f"(?i){R.DEALER}") | p.rlike(f"(?i){R.DEALER}"), "dealer")
            .otherwise("generic")
        )

    return F.when(F.coalesce(url, F.lit("")) == "", "generic").otherwise(F.get(F.transform(parts, named), F.lit(0)))


def trust(source_class: Column) -> Column:
    return F.coalesce(*[F.when(source_class == k, F.lit(v)) for k, v in R.TRUST.items()], F.lit(R.TRUST["generic"]))


def source_confidence(extraction: Column | float, url: Column, table: Column | bool = False) -> Column:
    """60 % extraction, 40 % trust in the source, and 0.05 for tables; between 0 and 1, three decimals."""
    extraction = F.lit(extraction) if isinstance(extraction, (int, float)) else extraction
    table = F.lit(table) if isinstance(table, bool) else table
    return class_confidence(extraction, classify_source(url), table)


def class_confidence(extraction: Column | float, source_class: Column, table: Column | bool = False) -> Column:
    """The confidence of :func:`source_confidence` where a source's class is known."""
    extraction = F.lit(extraction) if isinstance(extraction, (int, float)) else extraction
    table = F.lit(table) if isinstance(table, bool) else table
    trusted = F.get(F.transform(F.array(source_class), trust), F.lit(0))
    raw = extraction * 0.6 + trusted * 0.4 + F.when(table, 0.05).otherwise(0.0)
    return F.least(F.greatest(F.round(F.round(raw, 9), 3), F.lit(0.0)), F.lit(1.0))


def is_blocked(url: Column) -> Column:
    """Whether the authority is a blocked domain or below one; null addresses are blocked."""
    return F.coalesce(in_domains(authority(url), R.BLOCKED_DOMAINS), F.lit(True))


def _v4(text: Column) -> Column:
    """A dotted address as a number; null for anything else."""
    octets = F.split(text, r"\.")
    valid = text.rlike(r"^(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)$")
    value = sum((F.get(octets, F.lit(i)).try_cast("bigint") * (256 ** (3 - i)) for i in range(4)), F.lit(0).cast("bigint"))
    return F.when(valid, value)


def in_networks(number: Column, networks: tuple[str, ...] = R.PRIVATE_V4) -> Column:
    nets = [ipaddress.ip_network(n) for n in networks]
    found = F.lit(False)
    for n in nets:
        found = found | number.between(int(n.network_address), int(n.broadcast_address))
    return found


def _private_v6(text: Column) -> Column:
    """Whether an IPv6 address is local, link-local, unique-local or a private IPv4 address mapped into it."""
    t = F.lower(F.regexp_replace(text, "%.*$", ""))
    mapped = _v4(F.regexp_extract(t, r"^[0:]*:ffff:(\d+\.\d+\.\d+\.\d+)$", 1))
    high, low = (F.conv(F.regexp_extract(t, r"^[0:]*:ffff:([0-9a-f]{1,4}):([0-9a-f]{1,4})$", i), 16, 10).cast("bigint") for i in (1, 2))
    v4 = F.coalesce(in_networks(F.coalesce(mapped, high * 65536 + low)), F.lit(False))
    return t.rlike(r"^[0:]*:0*1$|^f[cd][0-9a-f]{2}:|^fe[89ab][0-9a-f]:") | v4


def is_private_ip(text: Column, v6: bool = True) -> Column:
    """Whether a text is an address in a private or reserved network; v6=False leaves IPv6 out."""
    v4 = F.coalesce(in_networks(_v4(text)), F.lit(False))
    return F.when(text.contains(":"), F.coalesce(_private_v6(text), F.lit(False))).otherwise(v4) if v6 else v4


def is_safe(url: Column, resolver=None, v6: bool = True) -> Column:
    """Whether an address may be fetched: http(s), at most 2,048 characters, a host that is neither blocked nor private.

    resolver, if given, is a Column function that tells whether a host name resolves to public
    addresses only (fail closed); without one, names are not resolved. Null is not safe.
    """

    def public(h: Column) -> Column:
        fine = (h != "") & ~h.isin(*R.BLOCKED_HOSTS) & ~is_private_ip(h, v6)
        return fine if resolver is None else fine & (_v4(h).isNotNull() | h.contains(":") | resolver(h))

    # the host is taken out of the address once, however often the rules ask for it
    ok = (F.length(url) > 0) & (F.length(url) <= R.MAX_URL) & scheme(url).isin("http", "https") & F.get(F.transform(F.array(host(url)), public), F.lit(0))
    return F.coalesce(ok, F.lit(False))


def sanitize(url: Column, v6: bool = True) -> Column:
    """Trimmed, with https:// where no http(s) scheme is given; "" where blank or unsafe."""
    t = F.trim(url)
    full = F.when(t.rlike(r"^https?://"), t).otherwise(F.concat(F.lit("https://"), t))
    return F.when((t != "") & is_safe(full, v6=v6), full).otherwise("")


def is_pdf(url: Column) -> Column:
    return F.lower(url).endswith(".pdf")
