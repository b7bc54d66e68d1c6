import hashlib
import random

import pytest
from pyspark.sql import functions as F

from broadleaf.functions import text
from broadleaf.functions import images as I
from broadleaf.operators import editorial, incremental, plan, privacy, validate
from broadleaf.plans import catalogue
from broadleaf.sources import mail


def sequential(cands):
    """The front page of (sector, pos) in order, one choice at a time."""
    lead = next((c for c in cands if c[0] == "tldr"), cands[0])
    rest = [c for c in cands if c != lead]
    second = []
    for want_new in (True, False):
        for c in rest:
            if len(second) < 4 and c not in second and (not want_new or c[0] not in {lead[0], *(x[0] for x in second)}):
                second.append(c)
    briefs = [c for c in rest if c not in second][: 8 - len(second)]
    return [(lead, "lead"), *((c, "secondary") for c in second), *((c, "brief") for c in briefs)]


def test_front_page_against_sequential(spark):
    rng, rows, want = random.Random(5), [], {}
    for d in range(60):
        cands = [(rng.choice(["tldr", "tldr-ai", "x", "y", "z"]), p) for p in range(rng.randint(1, 14))]
        rows += [(d, s, p) for s, p in cands]
        want[d] = sequential(cands)
    got = {}
    for r in editorial.fallback(spark.createDataFrame(rows, "d int, sector string, pos int"), "d", "sector", "pos").orderBy("d", "rk").collect():
        got.setdefault(r.d, []).append(((r.sector, r.pos), r.role))
    assert got == want


ARTICLE = "date string, issue_id string, sector_slug string, section_heading string, si int, ai int, id string, title string, summary string, url string, source_domain string, reading_time_minutes int, content_type string, is_sponsor boolean"


def article(**kw):
    base = {"date": "d", "issue_id": "i", "sector_slug": "tldr", "section_heading": "h", "si": 0, "ai": 0, "id": "a", "title": "T", "summary": "s", "url": "https://e.example/a", "source_domain": None, "reading_time_minutes": None, "content_type": "editorial", "is_sponsor": False}
    return tuple((base | kw).values())


def test_candidates(spark):
    rows = [
        article(), article(ai=1, id="b", title=" "), article(ai=2, id="c", url=None), article(ai=3, id="a", is_sponsor=True), article(ai=4, id="d", url="https://e.example/x?utm_source=1"),
        article(ai=5, id="e", url="https://E.example/x#f"), article(ai=6, id="f", url="https://e.example/x", content_type="Tool"), article(issue_id="j", sector_slug="zz", id="g", url="https://e.example/g", source_domain="W.example"),
    ]
    got = {r.article_id: (r.content_class, r.canonical_url, r.source_domain) for r in editorial.candidates(spark.createDataFrame(rows, ARTICLE)).collect()}
    assert got == {"a": ("sponsor", "https://e.example/a", "e.example"), "d": ("editorial", "https://e.example/x", "e.example"), "f": ("resource", "https://e.example/x", "e.example"), "g": ("editorial", "https://e.example/g", "w.example")}


def test_shortlist_is_balanced(spark):
    rows = [article(sector_slug=s, ai=k, id=f"{s}{k}", url=f"https://e.example/{s}{k}") for s in ("zz", "tldr-ai", "tldr") for k in range(5)]
    got = editorial.shortlist(editorial.candidates(spark.createDataFrame(rows, ARTICLE)), 6).orderBy("n").collect()
    assert [(r.candidate_id, r.article_id) for r in got] == [("c001", "tldr0"), ("c002", "tldr-ai0"), ("c003", "zz0"), ("c004", "tldr1"), ("c005", "tldr-ai1"), ("c006", "zz1")]


def test_first_broken_rule_of_a_plan(spark):
    known = spark.createDataFrame([("d", "c1", "s", True), ("d", "c2", "s", True), ("d", "c3", "s", False)], "date string, candidate_id string, sector_slug string, eligible boolean")
    page = lambda *e: '{"lead_candidate_id":"c1","front_page":[' + ",".join(e) + '],"section_order":["s"],"visual_brief":{"mode":"none","source_candidate_ids":[],"central_subject":%s,"visual_metaphor":"","composition":"","forbidden_elements":[],"alt_text":""}}'
    one, two = '{"candidate_id":"c1","role":"lead"}', '{"candidate_id":"c2","role":"brief"}'
    cases = [
        (page(one, two) % '""', None), (page(one, two) % "5", "plan_invalid_central_subject"), (page(one, two) % '{"a":1}', "plan_invalid_central_subject"), (page(one, two).replace('"c1",', "1,", 1) % '""', "plan_invalid_lead_id"),
        (page(one, two).replace('"c1",', '"\\t",', 1) % '""', "plan_invalid_lead_id"), (page('"x"', two) % '""', "plan_entry_properties"), (page('{"candidate_id":"c9","role":"lead"}', '{"candidate_id":"c2","role":"brief","x":1}') % '""', "plan_unknown_candidate"), (page(one) % '""', "plan_front_page_count"),
    ]
    for content, want in cases:
        assert plan.validate(spark.createDataFrame([("d", content)], "date string, content string"), known).collect()[0].error == want, content


def test_raw_privacy(spark):
    text = "a https://u:p@x.example/ b https://y.example/?Email=1&api-key=2). [https://z.example/b?c=d]|Jobs http://[bad/ https://y.example/?api_key=2"
    got = spark.createDataFrame([(text,)], "t string").select(privacy.findings(F.col("t")).alias("f")).collect()[0].f
    assert [(f.category, f.host, f.key) for f in got] == [("url_userinfo", "x.example", None), ("subscriber_or_management_url", "y.example", "email"), ("credential_query_parameter", "y.example", "api_key"), ("invalid_url", "", None)]
    rows = [("  \tx https://y.example/?contact_id=1). \t\r\nend\r\r\n",), ("k https://stratechery.com/a?access_token=1&b=2#f now",), ("k https://y.example/?jwt=1 now",)]
    done = privacy.prepared(spark.createDataFrame(rows, "text string")).collect()
    assert (done[0].prepared, done[0].categories, done[0].changed) == ("\tx ).\nend\n", ["subscriber_or_management_url"], True)
    assert done[1].prepared == "k https://stratechery.com/a?b=2#f now\n"
    assert done[2].prepared is None and done[2].error.key == "jwt"


def test_upsert_keeps_the_last(spark):
    old = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "issue_id string, v int")
    new = spark.createDataFrame([("b", 9), ("c", 9)], "issue_id string, v int")
    assert sorted(map(tuple, incremental.upsert(old, new, order="v").collect())) == [("a", 2), ("b", 9), ("c", 9)]


def test_mail(spark):
    raw = b"From: News <n@e.example>\r\nDate: Tue, 02 Jan 2024 23:30:00 -0800\r\nMessage-ID: <1@e>\r\nContent-Type: multipart/alternative; boundary=b\r\n\r\n--b\r\nContent-Type: text/plain; charset=utf-8\r\n\r\nfirst\r\n--b\r\nContent-Type: text/plain; charset=utf-8\r\nContent-Transfer-Encoding: quoted-printable\r\n\r\ncaf=C3=A9=\r\n!\r\n--b--\r\n"
    r = mail.landed(spark.createDataFrame([(1, bytearray(raw)), (2, bytearray(b""))], "uid int, content binary")).collect()
    assert [(x.relative_path, x.body.strip()) for x in r] == [("News/article_02-01-2024.md", "café!")]
    assert mail.html_articles('<div class="text-block"><a href="u"><strong>A &amp; B</strong></a><span>s</span></div>' * 2) == [("A & B", "u", "s")]


def test_prompt_and_staleness(spark):
    df = spark.createDataFrame([(["x"], [("T", "S")])], "ban array<string>, stories array<struct<title:string,summary:string>>")
    got = df.select(editorial.prompt(F.lit("P"), F.col("stories"), F.lit("a"), F.lit("b"), F.lit("c"), F.col("ban")).alias("p")).collect()[0].p
    assert got.split("\n")[:5] == ["P", "", "Source stories (use only these facts):", "Title: T", "Summary: S"] and got.endswith("Forbidden elements: x\n")
    art = spark.createDataFrame([("d1", "h", "2"), ("d2", "old", "1")], "date string, input_hash string, schema_version string")
    now = spark.createDataFrame([("d1", "h"), ("d2", "new")], "date string, input_hash string")
    assert [r.date for r in editorial.stale(art, now).collect()] == ["d2"]
    assert {r.date: r.reasons for r in editorial.mismatches(art, {"schema_version": "2"}).collect()} == {"d1": [], "d2": ["schema_version_mismatch"]}


def test_image_rules(spark):
    def webp(w, h):
        body = b"VP8X" + bytes(4) + bytes(4) + (w - 1).to_bytes(3, "little") + (h - 1).to_bytes(3, "little")
        return b"RIFF" + (len(body) + 4).to_bytes(4, "little") + b"WEBP" + body

    lossy = b"VP8 " + bytes(4) + bytes(3) + b"\x9d\x01\x2a" + (600).to_bytes(2, "little") + (400).to_bytes(2, "little") + bytes(4)
    lossy = b"RIFF" + (len(lossy) + 4).to_bytes(4, "little") + b"WEBP" + lossy
    cases = [(webp(600, 400), None), (webp(600, 500), "image_aspect_ratio_invalid"), (webp(100, 66), "image_dimensions_unreasonable"), (b"", "image_empty"), (b"x" * 2000, "image_too_large"), (b"RIFF" + bytes(40), "image_webp_malformed"), (lossy, None)]
    df = spark.createDataFrame([(i, bytearray(d)) for i, (d, _) in enumerate(cases)], "i int, d binary")
    assert [r.e for r in df.select("i", I.image_error(F.col("d"), F.lit("image/webp"), 1000).alias("e")).orderBy("i").collect()] == [e for _, e in cases]


def test_registry_and_gate(spark):
    with pytest.raises(ValueError):
        validate.unique_registry(spark.createDataFrame([("a",), ("a",)], "k string"), "k")
    with pytest.raises(ValueError):
        editorial.bounded_product(spark.range(10), spark.range(10).toDF("b"), 99)
    with pytest.raises(ValueError):
        incremental.must_be_clean(spark.range(1))


def test_second_prompt_and_hash(spark):
    brief = F.struct(*(F.lit(x).alias(k) for k, x in (("editorial_idea", "i"), ("central_subject", "c"), ("visual_relationship", "r"), ("composition", "o"), ("abstraction_level", "low"))), *(F.array(F.lit("x"), F.lit("y")).alias(k) for k in ("literal_elements", "forbidden_elements", "failure_modes")))
    df = spark.createDataFrame([([("T", "S")],)], "stories array<struct<title:string,summary:string>>")
    row = df.select(editorial.prompt_2(F.lit("P"), F.col("stories"), brief, ["no text"]).alias("p"), text.hash_parts(text.canonical_json(F.struct(F.lit(1).alias("a"), F.lit(None).cast("string").alias("b"), F.lit("\x0b\x1f\"\\u000B").alias("c")))).alias("h")).collect()[0]
    assert row.p.split("\n")[:8] == ["Rendering style:", "P", "", "Exact source facts:", "Title: T", "Summary: S", "", "Editorial idea:"] and row.p.endswith("Global factual restrictions:\nno text\n")
    data = b'{"a":1,"b":null,"c":"\\u000b\\u001f\\"\\\\u000B"}\n'
    assert row.h == "sha256:" + hashlib.sha256(len(data).to_bytes(8, "big") + data).hexdigest()


def test_windowed_counts(spark, tmp_path):
    from broadleaf.streaming.ingest import landing, windowed_counts

    rows = spark.createDataFrame([(1, "2024-01-01 00:10:00", "a", 1.0), (2, "2024-01-01 00:50:00", "a", 2.0), (3, "2024-01-01 01:10:00", "b", 3.0), (4, "2024-01-02 00:00:00", "a", 0.0)], "event_id long, t string, event_type string, value double").select("event_id", F.to_timestamp("t").alias("ts"), "event_type", "value")
    rows.write.parquet(str(tmp_path / "in"))
    q = windowed_counts(landing(spark, str(tmp_path / "in"), rows.schema)).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {(r.start.hour, r.event_type, r.n, r.total) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(0, "a", 2, 3.0), (1, "b", 1, 3.0)}  # the last window stays open


def test_json_of_plans_is_read_as_python_reads_it(spark):
    import json

    from broadleaf.operators import plan

    cases = ['{"a":1,"a":2}', '{"a":NaN}', '{"a":[-Infinity,Infinity]}', '{"NaN":"Infinity -Infinity \\" NaN","b":-1}', '{"a":-NaN}', '{"a":NaN,}', 'NaN', '{"a":Nan}', '{"a":1} {"b":2}', '{}', ' {"a":{"b":1,"b":[NaN]}} ', '"NaN', '{"a":1e999}', '["x"]']
    plans = spark.createDataFrame(list(enumerate(cases)), "k int, content string")
    none = spark.createDataFrame([], "k int, candidate_id string, sector_slug string, eligible boolean")
    got = {r.k: r.error for r in plan.validate(plans, none, "k").collect()}

    def wanted(text):
        try:
            return "plan_unknown_properties" if isinstance(json.loads(text), dict) else "plan_not_object"
        except ValueError:
            return "plan_malformed_json"

    assert got == {k: wanted(t) for k, t in enumerate(cases)}
