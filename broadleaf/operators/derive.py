"""Raw text to issue documents: paragraphs, headings, items, links, warnings, status.

The rules of the line parsers are reconstructed from their data contract and
fixtures; each assumption is noted where it is made.  All steps are relational:
one row per paragraph, windows over one issue, a left join to the link table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from broadleaf import fixed as V
from broadleaf.functions import text as X
from broadleaf.functions import urls as U

LINKS_MARK = r"\n[ \t]*Links:[ \t]*\n"
#: An item: capitals, a marker in brackets, and a reference or an address.
ITEM = r"^(.*\S)\s*\(([^()]+)\)\s*\[\s*(\d+|https?://[^\]]+?)\s*\]$"
#: The same without what the marker refers to.
BARE_ITEM = r"^(.*\S)\s*\((\d+\s+MINUTE\s+(?:READ|WATCH|VIDEO)|SPONSOR|GITHUB REPO|TOOL|COURSE|WEBSITE|PRODUCT[^()]*)\)$"
GENERAL = "GENERAL"


def clean(text: Column) -> Column:
    """Line feeds only, no zero-width characters, plain spaces, entities decoded (assumed order)."""
    return F.translate(X.strip_zero_width(X.decode_entities(X.line_feeds(text))), " ", " ")


def format_family(text: Column) -> Column:
    """A `Links:` line makes links_block, an address after a marker inline_url (assumed)."""
    return F.when(F.concat(F.lit("\n"), text, F.lit("\n")).rlike(LINKS_MARK), "links_block").when(text.rlike(r"\)\s*\[\s*https?://"), "inline_url").otherwise("unknown")


def link_table(issues: DataFrame) -> DataFrame:
    """T10 on rows of issue_id and text: (issue_id, ref, target), soft-wrapped addresses joined; of repeated refs the first."""
    block = F.regexp_extract(F.concat(F.lit("\n"), F.col("text")), rf"(?s){LINKS_MARK}(.*)$", 1)
    rows = issues.select("issue_id", F.posexplode(F.split(F.concat(F.lit("\n"), block), r"\n(?=[ \t]*\[\d+\])")).alias("pos", "item"))
    rows = rows.select("issue_id", "pos", F.regexp_extract("item", r"(?s)^\s*\[(\d+)\]", 1).alias("ref"), F.trim(F.regexp_extract("item", r"(?s)^\s*\[\d+\](.*)$", 1)).alias("target")).where("ref <> ''")
    return rows.groupBy("issue_id", F.col("ref").cast("int").cast("string").alias("ref")).agg(F.min_by("target", "pos").alias("target"))


def paragraphs(issues: DataFrame) -> DataFrame:
    """One row per paragraph of rows issue_id, sector, text: pos, line (from 1) and para with single spaces."""
    body = F.regexp_replace(F.concat(F.lit("\n"), F.col("text")), rf"(?s){LINKS_MARK}.*$", "\n")
    numbered = F.transform(F.split(X.without_footer(body), "\n"), lambda x, i: F.struct(i.alias("line"), X.stripped(x).alias("s")))
    rows = issues.select("issue_id", "sector", F.explode(numbered).alias("l")).select("issue_id", "sector", "l.*")
    by = W.partitionBy("issue_id").orderBy("line")
    rows = rows.withColumn("pos", F.sum((F.col("s") == "").cast("int")).over(by)).where("s <> ''")
    return rows.groupBy("issue_id", "sector", "pos").agg(F.min("line").alias("line"), F.regexp_replace(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "s"))), lambda x: x["s"]), " "), r"\s+", " ").alias("para"))


def _content_type(marker: Column) -> Column:
    """T15 (assumed from the contract's list)."""
    m = F.upper(marker)
    return F.when(m.rlike("SPONSOR"), "sponsor").when(m.rlike("GITHUB"), "github_repo").when(m.rlike("COURSE"), "course").when(m.rlike(r"\bTOOL\b"), "tool").otherwise("editorial")


def items(paras: DataFrame, links: DataFrame) -> DataFrame:
    """One row per item with heading, title, summary, url, ids and warning columns."""
    p = F.col("para")
    title = F.regexp_extract(p, ITEM, 1)
    capital = ~F.coalesce(F.nullif(title, F.lit("")), F.regexp_extract(p, BARE_ITEM, 1)).rlike(r"\p{Ll}{2,}")
    is_item = p.rlike(ITEM) & capital & F.regexp_extract(p, ITEM, 2).rlike(r"\p{Lu}")
    is_bare = ~is_item & p.rlike(BARE_ITEM) & capital
    word = F.upper(F.regexp_extract("sector", r"^(\S+)", 1))
    is_heading = ~is_item & ~is_bare & p.rlike(r"^[^\p{Ll}\[\]()]*\p{Lu}[^\p{Ll}\[\]()]*$") & ~p.rlike(r"\d{4}-\d{2}-\d{2}") & (p != F.upper("sector")) & (p != word) & (F.char_length(p) <= 80)
    rows = paras.select("*", is_item.alias("is_item"), is_bare.alias("is_bare"), is_heading.alias("is_heading"))
    by = W.partitionBy("issue_id").orderBy("pos")
    rows = rows.withColumn("heading", F.coalesce(F.last(F.when(F.col("is_heading"), p), ignorenulls=True).over(by), F.lit(GENERAL)))
    rows = rows.withColumn("section", F.sum(F.col("is_heading").cast("int")).over(by)).withColumn("item", F.sum((F.col("is_item") | F.col("is_bare")).cast("int")).over(by)).where("item > 0 and not is_heading")
    # the text after a heading and before its first item belongs to no item
    rows = rows.withColumn("own", F.max(F.when(F.col("is_item") | F.col("is_bare"), F.col("section"))).over(W.partitionBy("issue_id", "item"))).where("own = section")
    first = F.col("is_item") | F.col("is_bare")
    grouped = rows.groupBy("issue_id", "item").agg(
        F.max(F.when(first, p)).alias("head"),
        F.max(F.when(first, F.col("is_bare"))).alias("is_bare"),
        F.min("line").alias("line"),
        F.max("section").alias("section"),
        F.max("heading").alias("heading"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~first, F.struct("pos", "para")))), lambda x: x["para"]), "\n\n").alias("summary"),
    )
    pattern = lambda k: F.when(F.col("is_bare"), F.regexp_extract("head", BARE_ITEM, k)).otherwise(F.regexp_extract("head", ITEM, k))
    target = F.when(~F.col("is_bare"), F.regexp_extract("head", ITEM, 3))
    rows = grouped.select("*", pattern(1).alias("title"), pattern(2).alias("marker"), F.when(target.rlike(r"^\d+$"), target.cast("int").cast("string")).alias("ref"), F.when(~target.rlike(r"^\d+$"), target).alias("inline"))
    rows = rows.join(links, ["issue_id", "ref"], "left")
    url = U.public(F.coalesce("inline", "target"))
    nth = F.row_number().over(W.partitionBy("issue_id", "ref").orderBy("item"))
    ordinal = F.row_number().over(W.partitionBy("issue_id").orderBy("item"))
    base = F.when(F.col("ref").isNotNull(), F.concat(F.lit("a"), F.when(F.char_length("ref") < 2, F.lpad("ref", 2, "0")).otherwise(F.col("ref")))).otherwise(F.format_string("o%03d", ordinal))
    code = F.when(F.col("is_bare"), "missing_reference_number").when(F.col("ref").isNotNull() & F.col("target").isNull(), "dangling_reference")
    return rows.select(
        "issue_id", "item", "section", "heading", "title", "summary", "line",
        F.concat(F.col("issue_id"), F.lit(":"), base, F.when(F.col("ref").isNotNull() & (nth > 1), F.format_string("-%02d", nth)).otherwise("")).alias("id"),
        url.alias("url"),
        F.expr(r"try_cast(nullif(regexp_extract(marker, '(?i)(\\d+)\\s+MINUTE', 1), '') as int)").alias("reading_time_minutes"),
        U.domain(url).alias("source_domain"),
        _content_type(F.col("marker")).alias("content_type"),
        code.alias("code"), "ref",
    )


def _numbered(name: Column, n: Column) -> Column:
    return F.when(n > 1, F.concat(name, F.lit("-"), n.cast("string"))).otherwise(name)


ARTICLE_COLUMNS = ("item", "section", "heading", "id", "title", "summary", "url", "reading_time_minutes", "source_domain", "content_type", "code", "ref", "line")


def articles(rows: DataFrame) -> DataFrame:
    """issue_id and its items in order, from which sections, counts and warnings follow without another look at the items."""
    return rows.groupBy("issue_id").agg(F.array_sort(F.collect_list(F.struct(*ARTICLE_COLUMNS))).alias("articles"))


def sections(found: Column) -> Column:
    """An issue's sections with articles, in order; the n-th section of one name gets `-n`."""
    headings = F.array_distinct(F.transform(found, lambda a: F.struct(a["section"].alias("k"), a["heading"].alias("heading"))))
    named = F.transform(headings, lambda s: F.struct(s["k"].alias("k"), s["heading"].alias("heading"), X.slug(s["heading"]).alias("name")))

    def article(a: Column, i: Column) -> Column:
        own = [a[c].alias(c) for c in ("title", "summary", "url", "reading_time_minutes", "source_domain", "content_type")]
        return F.struct(a["id"].alias("id"), (i + 1).alias("order"), *own, (a["content_type"] == "sponsor").alias("is_sponsor"))

    def section(s: Column, i: Column) -> Column:
        nth = F.size(F.filter(F.slice(named, F.lit(1), i + 1), lambda t: t["name"] == s["name"]))
        own = F.transform(F.filter(found, lambda a: a["section"] == s["k"]), article)
        return F.struct(_numbered(s["name"], nth).alias("id"), s["heading"].alias("heading"), (i + 1).alias("order"), own.alias("articles"))

    return F.transform(named, section)


def warnings(found: Column) -> Column:
    """What an issue's items lack: code, message, line."""
    message = lambda a: F.when(a["code"] == "dangling_reference", F.concat(F.lit("Reference "), a["ref"], F.lit(" has no link definition"))).otherwise("Item has no reference number or address")
    return F.transform(F.filter(found, lambda a: a["code"].isNotNull()), lambda a: F.struct(a["code"].alias("code"), message(a).alias("message"), a["line"].cast("int").alias("line")))


def ordered_warnings(found: Column) -> Column:
    """By code, line (none first) and message."""
    keyed = F.transform(found, lambda w: F.struct(w["code"].alias("a"), F.coalesce(w["line"], F.lit(-1)).alias("b"), w["message"].alias("c"), w["line"].alias("line")))
    return F.transform(F.array_sort(keyed), lambda w: F.struct(w["a"].alias("code"), w["c"].alias("message"), w["line"].alias("line")))


def decide_status(n_articles: Column, n_material: Column, n_unresolved: Column, header_only: Column) -> Column:
    """Failed without articles, partial with a material warning or an unresolved editorial address, failed if only a header."""
    return F.when(n_articles == 0, "failed").when((n_material > 0) | (n_unresolved > 0), "partial").when(header_only, "failed").otherwise("complete")


def header_only(text: Column) -> Column:
    full = F.filter(F.split(X.line_feeds(X.stripped(text)), "\n"), lambda x: X.stripped(x) != "")
    return (F.size(full) <= 2) & ((F.size(full) == 0) | F.coalesce(F.get(full, F.lit(0)).startswith("#"), F.lit(True)))


def issues(sources: DataFrame) -> DataFrame:
    """Issue documents of source rows (see sources.corpus.named_sources)."""
    rows = sources.select("*", clean(F.col("content").cast("string")).alias("text")).select("*", X.issue_id(F.col("sector_slug"), F.col("date_iso")).alias("issue_id"), format_family(F.col("text")).alias("format_family"))
    links = link_table(rows.where("format_family <> 'inline_url'").select("issue_id", "text"))
    found = items(paragraphs(rows.select("issue_id", "sector", "text")), links)
    listed = articles(found)
    none, no_item = F.array().cast("array<struct<code:string,message:string,line:int>>"), F.array().cast(listed.schema["articles"].dataType)
    warning = lambda when, code, message: F.when(when, F.array(F.struct(F.lit(code).alias("code"), F.lit(message).alias("message"), F.lit(None).cast("int").alias("line")))).otherwise(none)
    rows = rows.withColumns({
        "_of_file": F.concat(warning(F.col("format_family") == "unknown", "unknown_format", "Could not detect links_block or inline_url format"), warning(X.stripped(F.col("text")) == "", "empty_body", "Source file is empty")),
        "_header_only": header_only(F.col("text")),
    }).drop("text", "content")
    full = rows.join(listed, "issue_id", "left").withColumn("articles", F.coalesce("articles", no_item))
    full = full.withColumn("parse_warnings", ordered_warnings(F.concat(warnings(F.col("articles")), F.col("_of_file"))))
    material = F.size(F.filter("parse_warnings", lambda w: w["code"].isin(*V.MATERIAL_WARNINGS)))
    unresolved = F.size(F.filter("articles", lambda a: a["url"].isNull() & (a["content_type"] != "sponsor")))
    status = decide_status(F.size("articles"), material, unresolved, F.col("_header_only"))
    return full.select(
        F.lit(V.SCHEMA_VERSION).alias("schema_version"), F.lit(V.GENERATOR_VERSION).alias("generator_version"),
        "issue_id", "sector", "sector_slug", F.col("date_iso").alias("date"), F.col("relative_path").alias("source_path"), F.col("content_hash").alias("source_content_hash"),
        "format_family", status.alias("parse_status"), "parse_warnings",
        F.concat_ws(" ", "sector", "date_iso").alias("title"),  # T20, assumed
        sections(F.col("articles")).alias("sections"),
    )
