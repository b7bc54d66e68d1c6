"""Text, name, date, hash and key functions as native expressions."""

from __future__ import annotations

import json
import re
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from broadleaf import fixed as V

#: Entities that the native decoder of single addresses knows, the ampersand last so that one pass decodes once.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": "\u00a0", "&middot;": "·", "&copy;": "©", "&amp;": "&"}
#: Codes that stand for characters of the old Windows code page, and two more that are replaced.
_OLD_CODES = {str(n): bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)} | {"0": "�", "13": "\r"}
SHA = r"^sha256:[0-9a-f]{64}$"
OBJECT_KEY = r"^(?:daily/\d{4}/\d{2}/\d{2}/[0-9a-f]{64}\.webp|podcast/daily/\d{4}/\d{2}/\d{2}/(?:en|fr)/[0-9a-f]{64}\.mp3)$"


def bound(value: Column, body) -> Column:
    """body(value), with the value computed once however often body has it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def is_sector(name: Column) -> Column:
    """S3."""
    return (name == V.SECTOR_WORD) | name.startswith(V.SECTOR_WORD + " ")


def slug(name: Column) -> Column:
    """lower-case words joined by single hyphens; `unknown` if nothing is left."""
    low = F.replace(F.lower(F.btrim(name, F.lit(" \t\n\r\x0b\x0c "))), F.lit(" "), F.lit("-"))
    tight = F.regexp_replace(F.regexp_replace(low, r"[^a-z0-9\-]+", ""), "-{2,}", "-")
    return F.coalesce(F.nullif(F.btrim(tight, F.lit("-")), F.lit("")), F.lit("unknown"))


def filename_date(name: Column) -> Column:
    """ISO date of `article_DD-MM-YYYY.md`; null if the form or the date is wrong."""
    return F.date_format(F.try_to_date(F.nullif(F.regexp_extract(name, r"^article_(\d{2}-\d{2}-\d{4})\.md$", 1), F.lit("")), "dd-MM-yyyy"), "yyyy-MM-dd")


def issue_id(slug_: Column, date: Column) -> Column:
    return F.concat_ws(":", slug_, date)


def issue_path(slug_: Column, date: Column) -> Column:
    """Where an issue's document is kept."""
    return F.concat(F.lit("issues/"), slug_, F.lit("/"), F.substring(date, 1, 4), F.lit("/"), date, F.lit(".json"))


def content_hash(data: Column) -> Column:
    """over the bytes as they are."""
    return F.concat(F.lit("sha256:"), F.sha2(data.cast("binary"), 256))


def canonical_json(value: Column) -> Column:
    """Compact JSON of any value and a line feed; the fields of a struct must be in alphabetical order. Codes of control characters in lower case."""
    compact = F.to_json(F.array(value), {"ignoreNullFields": "false"})
    compact = F.substring(compact, F.lit(2), F.char_length(compact) - 2)
    lowered = compact
    for code in ("0B", "0E", "0F", "1A", "1B", "1C", "1D", "1E", "1F"):
        lowered = F.regexp_replace(lowered, rf"(?<!\\)((?:\\\\)*)\\u00{code}", rf"$1\\u00{code.lower()}")
    return F.concat(F.when(compact.contains("\\u00"), lowered).otherwise(compact), F.lit("\n"))  # hardly any text has such a code


def sorted_json(text: Column) -> Column:
    """S20 for JSON text of any shape: compact, with the keys of every object in order, as the variant form keeps them; null if it is no JSON."""
    return F.to_json(F.try_parse_json(text))


def hash_parts(*parts: Column) -> Column:
    """hash of parts, each after its length as eight big-endian bytes; bytes as they are, other values by way of canonical_json."""
    sized = lambda x: F.concat(F.unhex(F.lpad(F.hex(F.octet_length(x).cast("long")), 16, "0")), x)
    # by way of an array each part is made once, although it is needed for its length, too
    return F.concat(F.lit("sha256:"), F.sha2(F.aggregate(F.array(*(p.cast("binary") for p in parts)), F.unhex(F.lit("")), lambda out, x: F.concat(out, sized(x))), 256))


def strip_zero_width(text: Column) -> Column:
    """F5."""
    return F.translate(text, "​‌‍﻿", "")


def unescape(text: Column) -> Column:
    """One pass over the entities listed here."""
    for entity, char in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


#: A number beyond all characters.
_NO_CODE = 1 << 30


def _numeric(code: Column) -> Column:
    """The character of a number, or what stands for it."""
    plane = F.pmod(code, F.lit(0x10000))
    unused = code.between(1, 8) | (code == 11) | code.between(14, 31) | (code == 127) | code.between(0xFDD0, 0xFDEF) | (plane >= 0xFFFE)
    swapped = F.element_at(F.from_json(F.lit(json.dumps(_OLD_CODES)), "map<string,string>"), code.cast("string"))
    character = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.coalesce(swapped, F.when(code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), "�").when(unused, "").otherwise(character))


def _code(number: Column) -> Column:
    """The value of `#12;` or `#xC;`."""
    digits = F.ltrim(F.regexp_extract(number, r"^#[xX]?([0-9a-fA-F]+)", 1), F.lit("0"))
    value = lambda d: F.when(F.char_length(d) > 8, _NO_CODE).when(d == "", 0).when(number.rlike(r"^#[xX]"), F.conv(d, 16, 10).cast("long")).otherwise(d.try_cast("long"))
    return bound(digits, value)


def _named(name: Column, table: Column, legacy: Column) -> Column:
    """What a name stands for; without its semicolon it may be the start of a longer word: the longest start that is a name."""
    starts = F.filter(F.transform(F.sequence(F.lit(6), F.lit(2), F.lit(-1)), lambda n: F.substring(name, F.lit(1), n)), lambda x: F.map_contains_key(legacy, x) & (F.char_length(x) < F.char_length(name)))
    cut = bound(F.get(starts, F.lit(0)), lambda x: F.concat(F.element_at(legacy, x), F.substring(name, F.char_length(x) + 1, F.lit(99))))
    return F.coalesce(F.element_at(table, name), cut, F.concat(F.lit("&"), name))


def _entity(part: Column, table: Column, legacy: Column) -> Column:
    """What follows an ampersand, with the entity that it starts with decoded, or with the ampersand."""
    found = F.regexp_extract(part, r"(?s)^(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)", 0)

    def decoded(x: Column) -> Column:
        out = F.when(x == "", "&").when(x.startswith("#"), bound(_code(x), _numeric)).otherwise(_named(x, table, legacy))
        return F.concat(out, F.substring(part, F.char_length(x) + 1, F.lit(1 << 30)))

    return bound(found, decoded)


def unescape_all(text: Column) -> Column:
    """One pass over all entities of HTML 5, by number and by name, as a browser decodes them; text without an ampersand is left alone."""
    table, legacy = (F.from_json(F.lit(json.dumps(t)), "map<string,string>") for t in (html5, {k: v for k, v in html5.items() if not k.endswith(";")}))
    decoded = lambda t: F.array_join(F.transform(F.split(t, "&"), lambda x, i: F.when(i == 0, x).otherwise(_entity(x, table, legacy))), "")
    return bound(text, lambda t: F.when(t.contains("&"), decoded(t)).otherwise(t))


def decode_entities(text: Column, full: bool = True) -> Column:
    """decoded twice by the whole entity table; else by the entities listed here."""
    return unescape_all(unescape_all(text)) if full else unescape(unescape(text))


def line_feeds(text: Column) -> Column:
    return F.regexp_replace(text, "\r\n?", "\n")


#: What ends a line, what is blank at its ends, and what is blank within it. Runs of these are possessive and start where the run starts, so that
#: each character of a run is looked at once.
ENDS = r"[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
LINE_END, BLANK = rf"(?:\r\n|{ENDS})", r"[\p{IsWhite_Space}\x1c-\x1f]"
NOT_END = r"[^\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
INNER = rf"[\p{{IsWhite_Space}}\x1c-\x1f&&{NOT_END}]"
LAST_BLANKS = rf"(?<!{BLANK}){BLANK}++\z"
#: What a footer's first line is, from its start on: by its own words, or by words anywhere in it.
BY_START = rf"{INNER}*+(?i:{'|'.join(V.FOOTER_STARTS)}|jobs? board\.?{INNER}*+(?={LINE_END}|\z))"
BY_WORD = rf"(?={NOT_END}*(?i:unsubscribe))(?={NOT_END}*(?:(?i:http)|\[))|(?={NOT_END}*(?i:/manage\?email=))"
FOOTER = rf"(?:{BY_START}|{BY_WORD})"
#: Words of which every line of BY_START has one, in lower case.
START_WORDS = ("job", *(re.split(r"[(?]", x)[0].strip() for x in V.FOOTER_STARTS))


def lines(text: Column) -> Column:
    """Lines without their ends, whichever of Unicode's line ends they have; no empty last one."""
    parts = F.split(text, LINE_END)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, rf"\A{BLANK}++|{LAST_BLANKS}", "")


def starts_footer(line: Column) -> Column:
    """T4, T5: whether a line starts the footer."""
    low = F.lower(line)
    by_word = low.contains("unsubscribe") & (low.contains("http") | low.contains("[")) | low.contains("/manage?email=")
    return by_word | line.rlike(rf"\A(?:{BY_START})")


def footer_at(text: Column) -> Column:
    """Where the line end before the first footer line stands, counting one line end put before the text; 0 if there is none.

    Only text that holds a word that a footer line must have is searched, and only text with the words of BY_WORD for those.
    """
    low, led = F.lower(text), F.concat(F.lit("\n"), text)
    some = low.contains("unsubscribe") | low.contains("/manage?email=")
    start = low.rlike("|".join(START_WORDS))
    either, first = (F.regexp_instr(led, F.lit(rf"{ENDS}(?:{x})")) for x in (FOOTER, BY_START))
    return F.when(text.isNull(), None).when(some, either).when(start, first).otherwise(0)


def cut_at(text: Column, at: Column) -> Column:
    """T4: text up to the line end that footer_at gives, right-trimmed, with line feeds only; as it is if that is 0."""
    kept = F.regexp_replace(F.substring(text, F.lit(1), at - 2), LINE_END, "\n")
    return F.when(at > 0, F.concat(F.regexp_replace(kept, LAST_BLANKS, ""), F.lit("\n"))).otherwise(text)


def without_footer(text: Column) -> Column:
    """T4: text up to the first footer line. Where the place is needed, too, use footer_at and cut_at."""
    return cut_at(text, footer_at(text))


def sector_rank(slug_: Column) -> Column:
    """place in the fixed order; unknown sectors come after, by name."""
    at = F.array_position(F.array(*map(F.lit, V.SECTOR_ORDER)), slug_)
    return F.when(at > 0, at - 1).otherwise(F.lit(len(V.SECTOR_ORDER)))


def sector_name(slug_: Column) -> Column:
    """The part of the order by name: empty for known sectors."""
    return F.when(slug_.isin(*V.SECTOR_ORDER), "").otherwise(slug_)


def candidate_id(n: Column) -> Column:
    """F12."""
    return F.format_string("c%03d", n.cast("int"))


def object_key(date: Column, sha: Column) -> Column:
    """key of a day's image; null for a wrong date or hash."""
    key = F.concat(F.lit("daily/"), F.translate(date, "-", "/"), F.lit("/"), F.substring(sha, 8, 64), F.lit(".webp"))
    return F.when(date.rlike(r"^\d{4}-\d{2}-\d{2}$") & sha.rlike(SHA), key)


def object_key_error(key: Column, date: Column) -> Column:
    """V6: null, `invalid_object_key` or `object_key_date_mismatch` (a null date isn't compared)."""
    day = F.translate(F.regexp_extract(key, r"^(?:podcast/)?daily/(\d{4}/\d{2}/\d{2})/", 1), "/", "-")
    return F.when(~key.rlike(OBJECT_KEY) | key.rlike(r"\n"), "invalid_object_key").when(date.isNotNull() & (day != date), "object_key_date_mismatch")


def public_object_url(base: Column, key: Column) -> Column:
    """null unless base is a bare https address and the key is valid."""
    ok = base.rlike(r"^https://[^/?#@\s]+[^?#]*$") & object_key_error(key, F.lit(None).cast("string")).isNull()
    return F.when(ok, F.concat(F.rtrim(base, F.lit("/")), F.lit("/"), F.array_join(F.transform(F.split(key, "/"), lambda x: F.replace(F.url_encode(x), F.lit("+"), F.lit("%20"))), "/")))


def finding_text(category: Column, host: Column, key: Column, path: Column | None = None) -> Column:
    """F14."""
    named = [F.lit("raw_privacy_violation")]
    if path is not None:
        named.append(F.concat(F.lit("path="), F.nullif(path, F.lit(""))))
    named += [F.concat(F.lit("category="), category), F.concat(F.lit("host="), F.coalesce(F.nullif(host, F.lit("")), F.lit("unknown"))), F.concat(F.lit("key="), F.nullif(key, F.lit("")))]
    return F.concat_ws(" ", *named)


def is_approved_source(path: Column) -> Column:
    """Below a sector folder, Markdown, relative, without `..`."""
    parts = F.split(path, "/")
    return ~path.startswith("/") & (F.size(F.filter(parts, lambda x: ~x.isin("", "."))) >= 2) & is_sector(parts[0]) & F.lower(path).endswith(".md") & ~F.array_contains(parts, "..")


def sender_sector(sender: Column) -> Column:
    """The sender's display name as a folder name."""
    return F.btrim(F.translate(F.regexp_replace(F.regexp_replace(sender, r"<[^>]*>", ""), r'["\\]', ""), "/", "-"))
