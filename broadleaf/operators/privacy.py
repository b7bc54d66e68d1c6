"""Privacy rules over raw text and over derived articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadleaf import fixed as V
from broadleaf.functions import urls as U


def _url_findings(url: Column) -> Column:
    """Findings (category, host, key) of one address, in order."""
    url = U.raw_trimmed(url)
    loc = U.netloc(url)
    host, pairs = U.hostname(loc), U.raw_pairs(url)
    none = F.lit(None).cast("string")
    finding = lambda category, h, key: F.struct(F.lit(category).alias("category"), h.alias("host"), key.alias("key"))
    subscriber = F.filter(pairs, lambda x: x["k"].isin(*V.RAW_SUBSCRIBER_KEYS))
    secret = F.filter(pairs, lambda x: x["k"].isin(*V.RAW_CREDENTIAL_KEYS))
    empty = F.array().cast("array<struct<category:string,host:string,key:string>>")
    found = F.concat(
        F.when(U.userinfo(loc).isNotNull(), F.array(finding("url_userinfo", host, none))).otherwise(empty),
        F.when(U.raw_private(url), F.array(finding("subscriber_or_management_url", host, F.get(subscriber, F.lit(0))["k"]))).otherwise(empty),
        F.transform(secret, lambda x: finding("credential_query_parameter", host, x["k"])),
    )
    return F.when(U.unbalanced(url), F.array(finding("invalid_url", F.lit(""), none))).otherwise(found)


def findings(text: Column) -> Column:
    """U-6, A7: all findings of a text, each once, in order of first sight."""
    return F.array_distinct(F.flatten(F.transform(F.regexp_extract_all(text, F.lit(U.RAW_URL), 0), _url_findings)))


def sanitized(raw: Column) -> Column:
    """U-8: struct of text, category and error (category, host, key) for one address."""
    url = U.raw_trimmed(raw)
    suffix = F.substring(raw, F.char_length(url) + 1, 1 << 30)
    loc = U.netloc(url)
    host, pairs = U.hostname(loc), U.raw_pairs(url)
    secret = F.array_sort(F.array_distinct(F.transform(F.filter(pairs, lambda x: x["k"].isin(*V.RAW_CREDENTIAL_KEYS)), lambda x: x["k"])))
    open_ = F.filter(secret, lambda k: ~((k == "access_token") & host.isin(*V.PUBLIC_CREDENTIALS["access_token"])))
    kept = F.array_join(F.transform(F.filter(pairs, lambda x: ~x["k"].isin(*V.RAW_CREDENTIAL_KEYS)), lambda x: x["raw"]), "&")
    rest = F.concat(U.scheme(url), F.lit("://"), loc, U.path(url), F.when(kept == "", "").otherwise(F.concat(F.lit("?"), kept)), F.when(U.fragment(url) == "", "").otherwise(F.concat(F.lit("#"), U.fragment(url))))
    error = lambda category, key: F.struct(F.lit(category).alias("category"), host.alias("host"), key.alias("key"))
    bad = F.when(U.unbalanced(url), error("invalid_url", F.lit(None).cast("string"))).when(U.userinfo(loc).isNotNull(), error("url_userinfo", F.lit(None).cast("string"))).when(~U.raw_private(url) & (F.size(open_) > 0), error("credential_query_parameter", F.get(open_, F.lit(0))))
    private, removed = U.raw_private(url), F.size(secret) > 0
    return F.struct(
        F.when(bad.isNotNull(), raw).when(private, suffix).when(removed, F.concat(rest, suffix)).otherwise(raw).alias("text"),
        F.when(bad.isNotNull(), None).when(private, "subscriber_or_management_url").when(removed, "credential_parameter_removed").alias("category"),
        bad.alias("error"),
    )


def _tidy(line: Column) -> Column:
    """Without trailing blanks, and without spaces before tabs in the indentation."""
    clean = F.rtrim(line, F.lit(" \t"))
    lead = F.regexp_extract(clean, r"^([ \t]*)", 1)
    return F.concat(F.regexp_replace(lead, " +(?=\t)", ""), F.substring(clean, F.char_length(lead) + 1, 1 << 30))


def prepared(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """U-9, U-10: docs with `prepared` text (null on an error), sorted distinct `categories`, the first `error`, and `changed`."""
    text = F.regexp_replace(F.col(text_col), "\r\n?", "\n")
    rows = docs.withColumn("_gaps", F.split(text, U.RAW_URL, -1)).withColumn("_urls", F.transform(F.regexp_extract_all(text, F.lit(U.RAW_URL), 0), sanitized))
    joined = F.array_join(F.zip_with("_gaps", F.transform("_urls", lambda u: u["text"]), lambda g, u: F.concat(g, F.coalesce(u, F.lit("")))), "")
    lines = F.array_join(F.transform(F.split(joined, "\n"), _tidy), "\n")
    errors = F.filter(F.transform("_urls", lambda u: u["error"]), lambda e: e.isNotNull())
    rows = rows.withColumn("error", F.get(errors, F.lit(0))).withColumn("categories", F.array_sort(F.array_distinct(F.filter(F.transform("_urls", lambda u: u["category"]), lambda c: c.isNotNull()))))
    rows = rows.withColumn("prepared", F.when(F.col("error").isNull(), F.concat(F.rtrim(lines, F.lit("\n")), F.lit("\n")))).drop("_gaps", "_urls")
    return rows.withColumn("changed", ~F.col("prepared").eqNullSafe(F.col(text_col)))


def article_hits(url: Column) -> Column:
    """U-5: what slipped through in an article's address; a private one is the only hit."""
    site = rf"(?:{V.NEWS_SITE}|{V.NEWS_MAIL_SITE})".replace(".", r"\.")
    others = F.filter(
        F.array(
            F.when(url.rlike(r"(?i)[?&](email|subscriber|subscriber_id)="), "subscriber parameter in article url"),
            F.when(url.rlike(rf"(?i)https?://(?:[\w.-]+\.)?{site}/[^\s]*(?:/manage(?:/|\?)|/unsubscribe(?:/|\?)|unsubscribe\?)"), f"{V.SECTOR_WORD} management url in article url"),
            F.when(url.rlike("(?i)" + "|".join(h.replace(".", r"\.") for h in V.ACCOUNT_HOSTS)), "referral/account url in article url"),
        ),
        lambda x: x.isNotNull(),
    )
    return F.when(F.coalesce(url, F.lit("")) == "", F.array().cast("array<string>")).when(U.is_private(url), F.array(F.lit("private url slipped through"))).otherwise(others)


def privacy_gate(found: DataFrame, findings_col: str = "findings") -> bool:
    """V7: whether no row has a finding."""
    return found.where(F.size(findings_col) > 0).isEmpty()
