from urllib.parse import parse_qsl, urlencode, urlsplit, urlunsplit

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from broadleaf import fixed as V
from broadleaf.functions import text as X
from broadleaf.functions import urls as U


def plain_canonical(url):
    p = urlsplit(url.strip())
    try:
        port = p.port
    except ValueError:
        return None
    if p.scheme not in ("http", "https") or not p.hostname or p.username or p.password:
        return None
    host = p.hostname + (f":{port}" if port and (p.scheme, port) not in (("http", 80), ("https", 443)) else "")
    kept = sorted((k, v) for k, v in parse_qsl(p.query, keep_blank_values=True) if k.lower() not in V.TRACKING_KEYS)
    return urlunsplit((p.scheme, host, p.path or "/", urlencode(kept), ""))


def column(spark, values, f):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, u string").select("i", f(F.col("u")).alias("x")).collect()
    return [r.x for r in sorted(rows, key=lambda r: r.i)]


CASES = [
    "HTTPS://Example.COM/a?z=2&utm_source=x&a=1#f", "http://e.com", "http://e.com:80/?", "https://e.com:443?a=%41&b=%zz&c=%", "https://e.com:8080/?a=~*+%20&a&=1", "https://u:p@e.com/", "http://:@e.com/", "http://@e.com/a",
    "ftp://e.com/", "https:///x", "nonsense", "", "https://e.com/?x=%E9", "https://e_x.com/a b?q=ü", "http://e.com:99999/", "http://e.com:ab/", "http://[::1]:80/x", "https://e.com/?UTM_SOURCE=1&Mc_Cid=2&k=v&k=a",
]


def test_canonical_cases(spark):
    assert column(spark, CASES, U.canonical) == [plain_canonical(u) for u in CASES]


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "utm_source", "é", "x y", ""]), st.text(alphabet="ab~*+ %&=#é/?", max_size=6)), min_size=20, max_size=40))
def test_canonical_property(spark, pairs):
    urls = [f"https://Host{i}.example/p?{k}={v}&z=1" for i, (k, v) in enumerate(pairs)]
    assert column(spark, urls, U.canonical) == [plain_canonical(u) for u in urls]


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("https://a.example/x?utm=1&amp;b=2#f", "https://a.example/x?utm=1&b=2"),
        ("https://a.example/ x\n?q=1).", "https://a.example/x?q=1"),
        (f"https://{V.NEWS_SITE}/ai/manage?email=a@b.c", None),
        (f"https://{V.ACCOUNT_HOSTS[1]}/1", None),
        ("https://a.example/?password=1", None),
        ("https://stratechery.com/?access_token=1&p=2", "https://stratechery.com/?p=2"),
        ("https://A.example/?email=x&t=1", "https://a.example/?t=1"),
        ("https://u@a.example/", None),
        ("mailto:a@b.example", None),
        ("", None),
        (None, None),
    ],
)
def test_public(spark, url, want):
    assert column(spark, [url], U.public) == [want]


def test_names_and_keys(spark):
    assert column(spark, ["TLDR AI", "  A  b--c!! ", "&&", "Éa"], X.slug) == ["tldr-ai", "a-b-c", "unknown", "a"]
    assert column(spark, ["article_31-02-2024.md", "article_01-03-2024.md", "article_1-3-2024.md", "article_01-03-2024.md.x"], X.filename_date) == [None, "2024-03-01", None, None]
    assert column(spark, ["TLDR/a.md", "/TLDR/a.md", "TLDR x/../a.md", "Other/a.md", "TLDR/b/c.MD", "TLDR/a.txt"], X.is_approved_source) == [True, False, False, False, True, False]
    key = "daily/2024/01/02/" + "0" * 64 + ".webp"
    assert column(spark, [key, key.upper(), key + "\n"], lambda k: X.object_key_error(k, F.lit("2024-01-02"))) == [None, "invalid_object_key", "invalid_object_key"]
    assert column(spark, [key], lambda k: X.object_key_error(k, F.lit("2024-01-03"))) == ["object_key_date_mismatch"]
