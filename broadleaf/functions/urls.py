"""URL functions as native expressions: splitting, canonical and public forms, privacy rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from broadleaf import fixed as V

from .text import bound, decode_entities, strip_zero_width, unescape_all

_SPLIT = r"(?s)^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"
RAW_URL = r"(?i)https?://[^\p{IsWhite_Space}\x1c-\x1f<>\"']+"


def _cleaned(url: Column) -> Column:
    return F.translate(F.btrim(url, F.lit("".join(map(chr, range(33))))), "\t\n\r", "")


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _SPLIT, 1))


def netloc(url: Column) -> Column:
    """Host with userinfo and port, as written."""
    return F.regexp_extract(url, _SPLIT, 2)


def path(url: Column) -> Column:
    return F.regexp_extract(url, _SPLIT, 3)


def query(url: Column) -> Column:
    return F.substring(F.regexp_extract(url, _SPLIT, 4), 2, 1 << 30)


def fragment(url: Column) -> Column:
    return F.substring(F.regexp_extract(url, _SPLIT, 5), 2, 1 << 30)


def userinfo(loc: Column) -> Column:
    """What stands before the last `@`; null without one."""
    return F.when(loc.contains("@"), F.regexp_extract(loc, r"^(.*)@[^@]*$", 1))


def hostname(loc: Column) -> Column:
    """Lower-case host without userinfo and port."""
    host = F.regexp_extract(loc, r"([^@]*)$", 1)
    return F.lower(F.when(host.startswith("["), F.regexp_extract(host, r"^\[([^\]]*)", 1)).otherwise(F.regexp_extract(host, r"^([^:]*)", 1)))


def port(loc: Column) -> Column:
    """Text of the port; empty without one."""
    return F.regexp_extract(loc, r"(?:\]|^[^\[\]]*?|@[^:@]*):([^:\]@]*)$", 1)


def decoded(part: Column) -> Column:
    """Form decoding: `+` is space, broken escapes stay."""
    return F.try_url_decode(F.regexp_replace(part, "%(?![0-9A-Fa-f]{2})", "%25"))


def encoded(part: Column) -> Column:
    """Form encoding that keeps letters, digits and `_.-~`."""
    return F.replace(F.replace(F.url_encode(part), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def pairs(q: Column) -> Column:
    """Decoded (k, v) of a query's non-empty parts, in order."""
    parts = F.filter(F.split(q, "&"), lambda x: x != "")
    return F.transform(parts, lambda x: F.struct(decoded(F.regexp_extract(x, r"(?s)^([^=]*)", 1)).alias("k"), decoded(F.regexp_extract(x, r"(?s)^[^=]*=(.*)$", 1)).alias("v")))


def joined(kept: Column) -> Column:
    return F.array_join(F.transform(kept, lambda x: F.concat(encoded(x["k"]), F.lit("="), encoded(x["v"]))), "&")


def canonical(url: Column) -> Column:
    """U-1: lower scheme and host, default port and fragment dropped, tracking keys dropped, pairs sorted; null if invalid."""
    url = _cleaned(url)
    s, loc = scheme(url), netloc(url)
    user, p = F.coalesce(userinfo(loc), F.lit("")), port(loc)
    number = F.when(p.rlike(r"^\d{1,5}$"), p.cast("int"))
    ok = s.isin("http", "https") & (hostname(loc) != "") & user.isin("", ":") & ((p == "") | (number <= 65535))
    default = (p == "") | (number == 0) | ((s == "http") & (number == 80)) | ((s == "https") & (number == 443))
    kept = F.array_sort(F.filter(pairs(query(url)), lambda x: ~F.lower(x["k"]).isin(*V.TRACKING_KEYS)))
    q = joined(kept)
    out = F.concat(s, F.lit("://"), hostname(loc), F.when(default, "").otherwise(F.concat(F.lit(":"), number.cast("string"))), F.when(path(url) == "", "/").otherwise(path(url)), F.when(q == "", "").otherwise(F.concat(F.lit("?"), q)))
    return F.when(ok, out)


def domain(url: Column) -> Column:
    """F8: host with port, lower case, without a leading `www.`; null if there is none."""
    return F.nullif(F.regexp_replace(F.lower(netloc(url)), r"^www\.", ""), F.lit(""))


def repaired(url: Column, full: bool = True) -> Column:
    """entities decoded, line breaks, spaces and zero-width characters dropped, trailing marks dropped."""
    out = strip_zero_width(F.translate(decode_entities(url, full), "\r\n ", ""))
    return F.rtrim(F.btrim(out, F.lit("\t\x0b\x0c ")), F.lit(V.TRAILING_MARKS))


def _site(host: Column, *names: str) -> Column:
    out = F.lit(False)
    for n in names:
        out = out | (host == n) | host.endswith("." + n)
    return out


def is_management_host(host: Column) -> Column:
    """U-4."""
    return _site(host, V.NEWS_SITE, V.NEWS_MAIL_SITE, *V.ACCOUNT_HOSTS)


def _parts(url: Column) -> Column:
    return F.struct(url.alias("url"), F.regexp_extract(url, _SPLIT, 1).alias("s"), netloc(url).alias("loc"), hostname(netloc(url)).alias("host"), path(url).alias("p"), query(url).alias("q"))


def _private(x: Column) -> Column:
    """U-3 for the parts of an address."""
    host, p, q = F.lower(x["loc"]), x["p"], x["q"]
    low = F.lower(F.concat(p, F.lit("?"), q))
    identity = q.rlike(r"(?i)(^|&)(email|subscriber|subscriber_id)=")
    return (
        (x["url"] == "")
        | _site(host, *V.ACCOUNT_HOSTS)
        | (_site(host, V.NEWS_MAIL_SITE) & (low.rlike(r"unsubscribe|/manage\b|preferences?|account") | identity))
        | (_site(host, V.NEWS_SITE) & (p.rlike(r"(?i)/(manage|unsubscribe|preferences?|account)(/|$|\?)") | (identity & F.lower(p).rlike("manage|unsubscribe"))))
        | (is_management_host(host) & p.rlike(r"(?i)(^|/)(unsubscribe|manage|preferences?|account|settings|email-preferences)(/|$|\?)"))
    )


def is_private(url: Column, repair: bool = True, full: bool = True) -> Column:
    """U-3: a subscription, account or referral link; empty counts as one."""
    return bound(repaired(url, full) if repair else url, lambda u: bound(_parts(u), _private))


def _public(x: Column) -> Column:
    """U-2 for the parts of a repaired address."""

    def of_pairs(found: Column) -> Column:
        key = lambda f: F.lower(f["k"])
        allowed = lambda k: F.coalesce(F.element_at(_hosts_by_key(), k), F.array().cast("array<string>"))
        hidden = F.exists(found, lambda f: key(f).isin(*V.CREDENTIAL_KEYS) & ~F.array_contains(allowed(key(f)), x["host"]))
        q = joined(F.filter(found, lambda f: ~key(f).isin(*V.SUBSCRIBER_KEYS, *V.CREDENTIAL_KEYS)))
        out = bound(q, lambda t: F.concat(F.lower(x["s"]), F.lit("://"), F.lower(x["loc"]), x["p"], F.when(t == "", "").otherwise(F.concat(F.lit("?"), t))))
        ok = F.lower(x["s"]).isin("http", "https") & (x["loc"] != "") & userinfo(x["loc"]).isNull() & ~hidden & ~_private(x)
        return bound(out, lambda u: F.when(ok & ~bound(_parts(u), _private), u))

    return bound(pairs(x["q"]), of_pairs)


def _hosts_by_key() -> Column:
    return F.create_map(*(c for k, hosts in V.PUBLIC_CREDENTIALS.items() for c in (F.lit(k), F.array(*map(F.lit, hosts)))))


def public(url: Column, full: bool = True) -> Column:
    """U-2: the URL without fragment, subscriber keys and removable credentials; null if private, invalid or not to be shown."""
    return bound(repaired(url, full), lambda u: bound(_parts(u), _public))


# -- rules over raw text -----------------------------------------------------


def raw_trimmed(url: Column) -> Column:
    return F.rtrim(url, F.lit(V.RAW_TRAILING_MARKS))


def unbalanced(url: Column) -> Column:
    """Whether the host has one bracket only, which no splitter accepts."""
    return netloc(url).contains("[") != netloc(url).contains("]")


def raw_pairs(url: Column) -> Column:
    """(k, raw) of the query's non-empty parts, entities decoded once."""
    parts = F.filter(F.split(unescape_all(query(url)), "&"), lambda x: x != "")
    return F.transform(parts, lambda x: F.struct(F.translate(F.lower(F.trim(decoded(F.regexp_extract(x, r"(?s)^([^=]*)", 1)))), "-", "_").alias("k"), x.alias("raw")))


def raw_private(url: Column) -> Column:
    """U-7."""
    host, p = hostname(netloc(url)), path(url)
    managed = p.rlike(r"(?i)(^|/)(unsubscribe|manage|preferences?|subscriptions?|account|settings|email-preferences)(/|$)")
    return (
        host.isin(*V.ACCOUNT_HOSTS)
        | (host.endswith("." + V.NEWS_MAIL_SITE) & (p.startswith("/web-version") | managed))
        | (_site(host, V.NEWS_SITE) & managed)
        | F.exists(raw_pairs(url), lambda x: x["k"].isin(*V.RAW_SUBSCRIBER_KEYS))
    )
