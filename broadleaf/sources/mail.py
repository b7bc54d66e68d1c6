"""Mail and legacy HTML sources; MIME and HTML need a parser, so these run in Arrow-fed functions."""

from __future__ import annotations

import email
import email.utils
import html
from collections.abc import Callable
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadleaf.functions import text as X


def plain_text(raw: bytes | None) -> str | None:
    """The last text/plain part, its transfer encoding undone, as UTF-8."""
    if raw is None:
        return None
    found = None
    for part in email.message_from_bytes(bytes(raw)).walk():
        if part.get_content_type() == "text/plain":
            found = (part.get_payload(decode=True) or b"").decode("utf-8", "replace")
    return found


MAIL = T.StructType([T.StructField(n, T.StringType()) for n in ("message_id", "sender", "date", "body")])


def _mail(raw: pd.Series) -> pd.DataFrame:
    """Message id, sender, the date in the sender's own offset, and the plain text of raw messages."""
    rows = []
    for data in raw:
        m = email.message_from_bytes(bytes(data or b""))
        sent = email.utils.parsedate_to_datetime(m["Date"]) if m["Date"] else None
        rows.append((m["Message-ID"], m["From"], sent.date().isoformat() if sent else None, plain_text(data)))
    return pd.DataFrame(rows, columns=[f.name for f in MAIL])


def parsed_mail(raw: Column | str) -> Column:
    return F.pandas_udf(_mail, MAIL)(raw)


def landed(messages: DataFrame) -> DataFrame:
    """S10, S12 on rows of uid and content: the file each message becomes, newest first by uid (L8); without sender, date or text there is none."""
    m = messages.select("uid", parsed_mail("content").alias("m")).select("uid", "m.*")
    sector = X.sender_sector(F.col("sender"))
    name = F.concat(sector, F.lit("/article_"), F.date_format(F.to_date("date"), "dd-MM-yyyy"), F.lit(".md"))
    return m.where(F.col("body").isNotNull() & name.isNotNull()).select(F.sha2(F.concat(F.coalesce("message_id", F.lit("")), F.col("uid").cast("string")), 256).alias("message_key"), "uid", sector.alias("sector"), name.alias("relative_path"), "body").orderBy(F.desc("uid"))


class _Blocks(HTMLParser):
    """Title, link and summary of each block: its first strong, a and span."""

    def __init__(self, tag: str, css_class: str | None):
        super().__init__(convert_charrefs=True)
        self.tag, self.css_class, self.depth, self.open, self.rows = tag, css_class, 0, None, []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == self.tag and (self.depth or self.css_class is None or self.css_class in (a.get("class") or "").split()):
            self.depth += 1
            if self.depth == 1:
                self.rows.append({})
        if self.depth and tag in ("strong", "a", "span") and tag not in self.rows[-1]:
            self.rows[-1][tag] = ""
            self.open = tag
            if tag == "a":
                self.rows[-1]["href"] = a.get("href")

    def handle_endtag(self, tag):
        if tag == self.tag and self.depth:
            self.depth -= 1
        if tag == self.open:
            self.open = None

    def handle_data(self, data):
        if self.depth and self.open:
            self.rows[-1][self.open] += data


def html_articles(text: str, tag: str = "div", css_class: str | None = "text-block", drop_last: bool = True) -> list[tuple[str, str | None, str]]:
    """(title, link, summary) of blocks that have a strong, an a and a span; the last of all is the sender's own."""
    p = _Blocks(tag, css_class)
    p.feed(text or "")
    tidy = lambda x: html.unescape(x).replace("\r\n", "").strip()
    found = [(tidy(r["strong"]), r.get("href"), tidy(r["span"])) for r in p.rows if {"strong", "a", "span"} <= set(r)]
    return found[:-1] if drop_last else found


BLOCKS = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("title", "link", "summary")]))


def _blocks(*how) -> Callable[[pd.Series], pd.Series]:
    def run(text: pd.Series) -> pd.Series:
        return text.map(lambda x: [{"title": t, "link": k, "summary": s} for t, k, s in html_articles(x, *how)])

    return run


def legacy_articles(text: Column) -> Column:
    return F.pandas_udf(_blocks(), BLOCKS, F.PandasUDFType.SCALAR)(text)


def legacy_tables(text: Column) -> Column:
    return F.pandas_udf(_blocks("table", None, False), BLOCKS, F.PandasUDFType.SCALAR)(text)


def tracked_target(text: Column, prefix: str = r"https://tracking\.[a-z]+\.=") -> Column:
    """The unquoted address between a tracking prefix and utm_source; `no_url` without one."""
    found = F.regexp_extract(text, prefix + r"(.+?)(?=utm_source)", 1)
    plain = F.regexp_replace(F.regexp_replace(found, r"\+", "%2B"), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.nullif(F.try_url_decode(plain), F.lit("")), F.lit("no_url"))


