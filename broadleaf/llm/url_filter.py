"""URL filter: host and path rules over a list of blocked canonical URLs.

The list becomes a blocked Bloom filter, built with bit_or aggregates: a block
is eight 64-bit words, a URL sets one bit in each word of its block.  A page's
URL passes only if all eight bits are set; an exact hash join with the list
then removes the false positives.  The filter is broadcast while its counted
size allows it; a larger one is joined to the distinct URLs by block number.
URLs are made distinct before any join on them, and the join back to the pages
is salted, so one URL may hold any share of the rows.

A rule is a host and a path prefix; it fits the host and its subdomains; the
longest rule (host and path together) decides.  Rules are a hand-written policy
and become one expression; the list may be of any size.

Defined results: a null url, or one without `://`, has an empty host and path,
fits no rule and is allowed; null and such list entries are ignored, repeated
ones count once; an empty list allows all; repeated pages each get a row; other
columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, written

BITS_PER_URL, WORDS, WORD_BITS = 16, 8, 64
BLOCK_ROW_BYTES = 120
SALTS = 32
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without `www.` and default port, path without a closing slash, query without utm_ parameters and sorted; null without `://`."""
    h = F.regexp_replace(F.regexp_replace(host(url), r"^www\.", ""), r":(80|443)$", "")
    p = F.regexp_replace(path(url), "/$", "")
    pairs = F.filter(F.split(F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1), "&"), lambda x: (x != "") & ~x.startswith("utm_"))
    query = F.array_join(F.sort_array(pairs), "&")
    return F.when(url.contains("://"), F.concat(h, p, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def rule_text(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule as host + path, and its verdict; nulls if none fits."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        text = F.when(fits, F.lit(rule_host + rule_path)).otherwise(text)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return text, verdict


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url, F.lit("block")), F.lit(blocks))


def _bit(url_hash: Column, word: int) -> Column:
    place = F.shiftrightunsigned(url_hash, 6 * word).bitwiseAND(F.lit(WORD_BITS - 1))
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int"))


def bloom(listed: DataFrame, n: int) -> tuple[DataFrame, int]:
    """(block, w0..w7) of a column `canonical` of n distinct URLs, and the number of blocks."""
    blocks = max(1, math.ceil(n * BITS_PER_URL / (WORDS * WORD_BITS)))
    h = F.xxhash64("canonical", F.lit("bits"))
    return listed.groupBy(_block(F.col("canonical"), blocks).alias("block")).agg(*(F.bit_or(_bit(h, k)).alias(f"w{k}") for k in range(WORDS))), blocks


def _probe(urls: DataFrame, words: DataFrame, blocks: int) -> DataFrame:
    """Rows of urls (with a column `canonical`) whose bits are all set."""
    h = F.xxhash64("canonical", F.lit("bits"))
    hit = F.lit(True)
    for k in range(WORDS):
        hit = hit & (F.col(f"w{k}").bitwiseAND(_bit(h, k)) != 0)
    return urls.withColumn("block", _block(F.col("canonical"), blocks)).join(words, "block").where(hit).drop("block", *(f"w{k}" for k in range(WORDS)))


def listed_hits(urls: DataFrame, listed: DataFrame) -> DataFrame:
    """Distinct `canonical` of urls that are in listed (columns `canonical`); exact."""
    listed = written(listed.where("canonical is not null").select("canonical").distinct(), "listed")
    n = listed.count()
    words, blocks = bloom(listed, n)
    words = written(words, "bloom")
    if blocks * BLOCK_ROW_BYTES <= BROADCAST_BYTES:
        words = F.broadcast(words)
    maybe = _probe(urls.where("canonical is not null").select("canonical").distinct(), words, blocks)
    return maybe.join(listed.hint("shuffle_hash"), "canonical", "left_semi")


def judge(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict of each page; listed: a column url of blocked URLs."""
    url = F.col(url_col).cast("string")
    own = pages.select(F.col(id_col).alias("page_id"), url.alias("url"))
    urls = own.select(canonical(F.col("url")).alias("canonical"))
    hits = listed_hits(urls, listed.select(canonical(F.col("url").cast("string")).alias("canonical")))
    salted = hits.select("canonical", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(True).alias("hit"))
    rows = own.withColumn("canonical", canonical(F.col("url")))
    rows = rows.withColumn("canonical", F.coalesce("canonical", F.concat(F.lit("none "), F.pmod(F.xxhash64("page_id"), F.lit(1024)).cast("string"))))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")).join(salted, ["canonical", "salt"], "left")
    h, p = host(F.col("url")), path(F.col("url"))
    rows = rows.select("page_id", h.alias("host"), p.alias("path"), "hit")
    rule, says = rule_text(F.col("host"), F.col("path"), rules)
    return rows.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(says, F.when(F.col("hit"), F.lit("block")), F.lit("allow")).alias("verdict"))
