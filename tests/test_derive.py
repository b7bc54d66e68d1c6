from pyspark.sql import functions as F

from broadleaf import fixed as V
from broadleaf.operators import derive, editorial, validate
from broadleaf.sources import corpus

LINKED = """# Articles\r
\r
Preview‌ text  \r
\r
 FYI: A SPONSOR OF THE DAY (SPONSOR) [4] \r
\r
Some copy.\r
\r
BIG NEWS & MORE\r
\r
 A TITLE THAT WRAPS\r
OVER LINES (12 MINUTE\r
READ) [8] \r
\r
 First part\r
of a summary.\r
\r
Second part.\r
\r
 SAME REFERENCE AGAIN (GITHUB REPO) [8] \r
\r
 MISSING TARGET (2 MINUTE READ) [99] \r
\r
Text.\r
\r
JOB BOARD\r
\r
 NOT AN ITEM ANY MORE (1 MINUTE READ) [8] \r
\r
Links:\r
------\r
[4] https://sponsor.example/?utm_source=a&amp;b=1\r
[8] https://news.example/path/\r
of-page?x=1\r
"""
INLINE = "# Articles\n\nTOP\n\nONE THING (3 MINUTE READ) [https://one.example/a?utm_source=x]\n\nSummary.\n\nANOTHER (2\nMINUTE READ)\n[https://two.example/]\n\nMore.\n\nTOP\n\nTHIRD (WEBSITE) [https://three.example]\n\nThanks for reading,\n\nFOURTH (1 MINUTE READ) [https://no.example]\n"


def sources(spark, **texts):
    names = {k: f"{V.SECTOR_WORD} {k.split('_')[0]}/article_{k.split('_')[1]}-01-2024.md" for k in texts}
    rows = [(names[k], bytearray(v.encode())) for k, v in texts.items()]
    return corpus.named_sources(spark.createDataFrame([*rows, ("Other/article_01-01-2024.md", bytearray(b"x")), (f"{V.SECTOR_WORD}/article_31-02-2024.md", bytearray(b"x"))], "relative_path string, content binary"))


def test_issues(spark):
    rows = derive.issues(sources(spark, AI_01=LINKED, Dev_02=INLINE, Web_03="# Articles\n", Web_04="")).orderBy("source_path").collect()
    linked, inline, header, empty = rows
    assert linked.source_content_hash != inline.source_content_hash and len(rows) == 4
    assert (linked.format_family, linked.parse_status, [w.code for w in linked.parse_warnings]) == ("links_block", "partial", ["dangling_reference"])
    assert [(s.id, s.order) for s in linked.sections] == [("general", 1), ("big-news-more", 2)]
    a, b, c = linked.sections[1].articles
    assert (a.title, a.url, a.reading_time_minutes, a.summary, a.source_domain) == ("A TITLE THAT WRAPS OVER LINES", "https://news.example/path/of-page?x=1", 12, "First part of a summary.\n\nSecond part.", "news.example")
    assert [x.id.split(":")[-1] for x in (a, b, c)] == ["a08", "a08-02", "a99"] and (b.content_type, c.url) == ("github_repo", None)
    assert linked.sections[0].articles[0].is_sponsor and linked.sections[0].articles[0].url == "https://sponsor.example/?utm_source=a&b=1"
    assert (inline.format_family, inline.parse_status) == ("inline_url", "complete")
    assert [(s.id, [x.id.split(":")[-1] for x in s.articles]) for s in inline.sections] == [("top", ["o001", "o002"]), ("top-2", ["o003"])]
    assert (header.parse_status, header.format_family) == ("failed", "unknown")
    assert [w.code for w in empty.parse_warnings] == ["empty_body", "unknown_format"]


def test_ids_do_not_depend_on_summaries(spark):
    one = derive.issues(sources(spark, AI_01=LINKED)).select(F.explode(F.flatten("sections.articles")).alias("a")).select("a.id").collect()
    two = derive.issues(sources(spark, AI_01=LINKED.replace("Second part.", "Quite another text."))).select(F.explode(F.flatten("sections.articles")).alias("a")).select("a.id").collect()
    assert one == two


def test_reports_and_manifest(spark, tmp_path):
    found = derive.issues(sources(spark, AI_01=LINKED, Dev_02=INLINE, Web_03="# Articles\n"))
    maps = validate.count_maps(found).collect()[0]
    assert (maps.source_count, maps.parse_status_counts, maps.warning_code_counts) == (3, {"partial": 1, "complete": 1, "failed": 1}, {"dangling_reference": 1, "unknown_format": 1})
    corpus.issue_json(found).coalesce(1).foreach(lambda r: None)
    for r in corpus.issue_json(found).collect():
        (tmp_path / r.derived_path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / r.derived_path).write_text(r.json)
    manifest = corpus.manifest_entries(found)
    back = corpus.read_issues(spark, str(tmp_path / "issues"))
    assert back.select("issue_id", "title", "sections").exceptAll(found.select("issue_id", "title", "sections")).isEmpty()
    day = editorial.load_date(manifest, back, "2024-01-01").collect()
    assert {(c.article_id.split(":")[-1], c.content_class) for c in day} == {("a04", "sponsor"), ("a08", "editorial"), ("a08-02", "resource")}
    assert editorial.latest_date(manifest).collect()[0].date == "2024-01-02"
    assert corpus.manifest_hashes(manifest).count() == 3
    assert validate.missing(manifest, manifest.limit(1), "derived_path").count() == 2


def test_discovery(spark, tmp_path):
    for p in (f"{V.SECTOR_WORD}/article_01-02-2024.md", f"{V.SECTOR_WORD} AI/article_30-02-2024.md", f"{V.SECTOR_WORD} AI/deep/article_01-02-2024.md", "Other <a@b.example>/article_01-02-2024.md", f"{V.SECTOR_WORD} AI/article_03-02-2024.md"):
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / p).write_bytes(b"a\r\nb")
    rows = corpus.discover(spark, str(tmp_path)).orderBy("sector_slug", "date_iso", "relative_path").collect()
    assert [(r.relative_path, r.date_iso, r.size_bytes) for r in rows] == [(f"{V.SECTOR_WORD}/article_01-02-2024.md", "2024-02-01", 4), (f"{V.SECTOR_WORD} AI/article_03-02-2024.md", "2024-02-03", 4)]
    assert corpus.read_manifest(spark, str(tmp_path / "manifest.json")).count() == 0
    assert corpus.resolve(spark, str(tmp_path), rows[0].relative_path).count() == 1
