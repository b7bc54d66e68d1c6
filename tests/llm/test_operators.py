"""Each operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing names, and against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from broadleaf.llm import decontaminate, importance, langid, near_dup, pii, quality_rules, queries, sentencepiece_sa, token_store, url_filter, warc
from broadleaf.llm.common import keep_texts, new_dir, table
from harness import same

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EN = "the quick brown fox jumps over the lazy dog while it rains and nobody is there to see how the evening ends"
DE = "der schnelle braune fuchs springt über den faulen hund während es regnet und niemand sieht wie der abend endet"


def variety(seed=1, n=400):
    """Words that repeat little, so that texts differ."""
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefgilmnorstu", k=rng.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (1, EN, "en", "a", 1), (2, DE, "de", "a", 1), (3, None, "en", None, None), (4, "", None, "a", 0), (5, " \n\t ", "en", "a", 3), (6, "1234 !!", "en", "b", 7), (7, EN, "en", "a", 1), (7, EN, "en", "a", 1),
        (None, DE, "de", "b", 1), (8, variety(2, 20_000), "en", "b", 1), (9, "日本語 テスト 😀\x0bx\u00a0y\u2028z <|endoftext|> don't", "ja", "c", 1), (10, "a", "en", "a", 1), (None, None, None, None, None), (11, EN + " with one more", "en", "a", 1),
    ]
    return spark.createDataFrame(rows, DOCS).withColumn("c0", F.lit("clash")).withColumn("t", F.lit(1)).withColumn("_node", F.lit(2.5))


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# -- 1 ------------------------------------------------------------------------


def test_url_filter(spark, sf_dir):
    same(queries.op1_url_filter(spark, sf_dir), queries.SQL["op1_url_filter"], sf_dir)
    pages = [(1, "http://WWW.A.org:80/x/?utm_source=1&b=2&a=1#f"), (2, "http://a.net/x"), (3, None), (4, "no scheme"), (5, "http://b.com/fr/1"), (6, "x://example.org?q"), (7, "http://a.net/x"), (None, "http://sub.example.org/en/12"), (8, "http://notexample.org/es/")]
    listed = spark.createDataFrame([("https://a.net/x/",), ("http://a.net/x",), (None,), ("junk",), ("http://b.com/fr/1",)], "url string")
    df = spark.createDataFrame(pages, "page_id long, url string").withColumn("hit", F.lit("clash")).withColumn("host", F.lit(1))
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(df, listed, queries.URL_RULES).collect()}
    assert got == {
        (1, "www.a.org:80", "/x/", None, "allow"), (2, "a.net", "/x", None, "block"), (3, "", "", None, "allow"), (4, "", "", None, "allow"), (5, "b.com", "/fr/1", "com/fr/", "allow"),
        (6, "example.org", "", None, "allow"), (7, "a.net", "/x", None, "block"), (None, "sub.example.org", "/en/12", "example.org/en/1", "block"), (8, "notexample.org", "/es/", "org/", "allow"),
    }
    assert url_filter.judge(df.limit(0), listed, []).count() == 0
    assert {r.verdict for r in url_filter.judge(df, listed.limit(0), []).collect()} == {"allow"}


@pytest.mark.parametrize("broadcast", [True, False])
def test_url_filter_is_exact(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(url_filter, "BROADCAST_BYTES", 0)
    listed = spark.range(3000).select(F.concat(F.lit("http://h.example/"), (F.col("id") * 2).cast("string")).alias("url"))
    pages = spark.range(4000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h.example/"), F.col("id").cast("string"), F.lit("#x")).alias("url"))
    blocked = {r.page_id for r in url_filter.judge(pages, listed, []).where("verdict = 'block'").collect()}
    assert blocked == set(range(0, 4000, 2))


# -- 2 ------------------------------------------------------------------------


def test_pii_forms_are_kept_and_reversible():
    p, back = pii.Pseudonyms(b"k"), pii.Pseudonyms(b"k", reverse=True)
    values = {
        "email": ["bob.smith99@mail5.example.com"], "phone": ["+1 (499) 555-6503", "(212) 555-0123", "+49 30 1234567"], "ip": ["188.54.39.104"], "card": ["4111 1111 1111 1111", "378282246310005", "5555555555554444"],
        "iban": ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"], "ssn": ["123-45-6789"], "date": ["1985-02-28", "31/12/1999", "12/31/1999", "1.5.2001"], "secret": ['token = "' + "1eb9c654" * 5], "mac": ["00:1A:2B:3C:4D:5E"],
    }
    for form, some in values.items():
        for v in some:
            new, counts = p.replace(f"x {v}, y")
            assert counts == {form: 1} and new != f"x {v}, y", v
            assert [c.isdigit() for c in new] == [c.isdigit() for c in f"x {v}, y"] or form in ("secret", "mac", "ip", "date"), v
            assert back.replace(new)[0] == f"x {v}, y"
            assert p.replace(f"{v}")[0] in new  # equal values, equal pseudonyms
    assert p.replace("4111111111111112 1.2.3 999.1.1.1 31-02-2000 000-12-3456 DE00370400440532013000 3.14159 2024")[1] == {}
    new = p.replace("+1 (499) 555-6503 2024, 4111111111111111 5, DE89370400440532013000 ABCD and 4111 1111 1111 1111 12")[0]  # numbers beside numbers
    assert new.endswith(" 12") and " 2024, " in new and " 5, DE" in new and " ABCD and " in new and back.replace(new)[1] == {"phone": 1, "card": 2, "iban": 1}
    assert pii.luhn(re.sub(r"\D", "", p.replace("4111 1111 1111 1111")[0]))
    for n in (1, 2, 7, 100, 1000):
        assert sorted(p.permute(i, n, "f") for i in range(n)) == list(range(n))
    assert len({p.date(f"{m:02d}/{d:02d}/2001") for m in range(1, 13) for d in range(1, 29)}) == 12 * 28


def test_pii_pseudonyms_stay_in_their_number_plans():
    p, back = pii.Pseudonyms(b"k"), pii.Pseudonyms(b"k", reverse=True)
    rng = random.Random(22)
    for _ in range(300):
        card = rng.choice(["4", "51", "2345", "6011", "3530"]) + "".join(rng.choices("0123456789", k=15))
        card = next(card[:15] + c for c in "0123456789" if pii.luhn(card[:15] + c))
        new = p.card(card)
        assert pii.is_card(new) and new[:4] == card[:4] and back.card(new) == card
        area, exchange = (rng.choice("23456789") + rng.choice("023456789") + rng.choice("0123456789") for _ in range(2))
        phone = f"({area}) {exchange}-{rng.randrange(10_000):04d}"
        new = p.phone(phone)
        assert new[1] in "23456789" and new[6] in "23456789" and new[2:4] != "11" and new[7:9] != "11" and back.phone(new) == phone
    assert p.replace("1232810148878564 0810992847249404 9980942693487187")[1] == {}  # no issuer has such numbers
    new, counts = p.replace("at 2024-01-05T10:00:00Z by jörg.müßig@bücher.münchen.example.de and 用户@例子.公司.example.cn")
    assert counts == {"date": 1, "email": 2} and "T10:00:00Z by " in new and new.endswith(".example.cn") and "jörg" not in new and "用户" not in new and "münchen" not in new
    assert back.replace(new)[0] == "at 2024-01-05T10:00:00Z by jörg.müßig@bücher.münchen.example.de and 用户@例子.公司.example.cn"


def plain_pseudonym(key, form, x, n):
    """A keyed permutation of 0..n-1, written again with big integers."""
    import math

    k, tag = hashlib.blake2b(key, digest_size=32).digest(), hashlib.blake2b(form.encode(), digest_size=15).digest()
    a = math.isqrt(n - 1) + 1
    b = (n + a - 1) // a
    while True:
        sides, sizes = [x // b, x % b], [a, b]
        for i in range(10):
            f = int.from_bytes(hashlib.blake2b(sides[1].to_bytes(64, "little"), digest_size=32, key=k, salt=tag + bytes([i]), person=b"feistel").digest(), "little")
            sides, sizes = [sides[1], (sides[0] + f) % sizes[0]], [sizes[1], sizes[0]]
        x = sides[0] * b + sides[1]
        if x < n:
            return x


def plain_pii(key, text):
    """The forms that the test documents hold, found by other patterns and replaced one form after another."""
    n = Counter()

    def spell(value, form):
        sets = [next((s for s in ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ") if c in s), "") for c in value]
        x = size = 0
        size = 1
        for c, s in zip(value, sets, strict=True):
            if s:
                x, size = x * len(s) + s.index(c), size * len(s)
        x, out = plain_pseudonym(key, form + "".join(s[:1] or c for s, c in zip(sets, value, strict=True)), x, size), []
        for c, s in zip(value[::-1], sets[::-1], strict=True):
            out.append(s[x % len(s)] if s else c)
            x //= len(s) or 1
        return "".join(out[::-1])

    def email(m):
        n["email"] += 1
        return spell(m[1], "email") + m[2]

    def phone(m):
        n["phone"] += 1
        body = new = re.sub(r"\D", "", m[0])[1:]
        plan = lambda d: d[0] in "23456789" and d[3] in "23456789" and d[1:3] != "11" and d[4:6] != "11"
        while True:
            new = f"{plain_pseudonym(key, 'phone1/10', int(new), 10**10):010d}"
            if plan(new) == plan(body):
                return f"+1 ({new[:3]}) {new[3:6]}-{new[6:]}"

    def ip(m):
        if any(int(x) > 255 or x != str(int(x)) for x in m[0].split(".")):
            return m[0]
        n["ip"] += 1
        x = 0
        for part in m[0].split("."):
            x = x * 256 + int(part)
        x = plain_pseudonym(key, "ip", x, 1 << 32)
        return ".".join(str(x >> s & 255) for s in (24, 16, 8, 0))

    def check(d):
        return sum(int(c) if k % 2 else sum(map(int, str(2 * int(c)))) for k, c in enumerate(reversed(d))) * 9 % 10

    def card(m):
        d = m[0]
        visa, master = d[0] == "4", 51 <= int(d[:2]) <= 55 or 2221 <= int(d[:4]) <= 2720
        others = d[:4] == "6011" or 644 <= int(d[:3]) <= 659 or 3528 <= int(d[:4]) <= 3589 or d[:2] in ("36", "38", "39", "62", "50", "56", "57", "58") or 300 <= int(d[:3]) <= 305 or d[:4] == "3095"
        if not (visa or master or others) or str(check(d[:-1])) != d[-1]:
            return d
        n["card"] += 1
        new = d[:4] + f"{plain_pseudonym(key, 'card16/' + d[:4], int(d[4:-1]), 10**11):011d}"
        return new + str(check(new))

    def secret(m):
        n["secret"] += 1
        x = plain_pseudonym(key, "secret40f", int(m[2], 16), 16**40)
        return m[1] + f"{x:040x}"

    for pattern, put in ((r"([\w+%.-]+@(?:\w+\.)*)(\w+\.[a-z]+)", email), (r"\+1 \(\d{3}\) \d{3}-\d{4}", phone), (r"(?<![\w.])\d+\.\d+\.\d+\.\d+(?![\w]|\.\d)", ip), (r"(?<![\w.])\d{16}(?!\w)", card), (r"(token = \")([0-9a-f]{40})", secret)):
        text = re.sub(pattern, put, text)
    return text, +n


def test_pii_of_all_documents_against_a_plain_replacer(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    old, back, seen = dict(texts(docs)), pii.Pseudonyms(b"k", reverse=True), Counter()
    for r in pii.pseudonyms(docs, b"k").collect():
        want, counts = plain_pii(b"k", old[r.doc_id] or "")
        assert (r.text or "", r.kinds) == (want, ",".join(f"{k}:{counts[k]}" for k in sorted(counts))), r.doc_id
        assert back.replace(r.text or "")[0] == (old[r.doc_id] or "")
        seen += counts
    assert set(seen) == {"email", "phone", "ip", "card", "secret"}


def test_pii_rows(spark, odd, none):
    df = odd.unionByName(spark.createDataFrame([(20, "mail a.b@c.example.com and a.b@c.example.com", "en", "a", 1)], DOCS).withColumn("c0", F.lit("clash")).withColumn("t", F.lit(1)).withColumn("_node", F.lit(2.5)))
    rows = {r.doc_id: r for r in pii.pseudonyms(df, b"k").collect()}
    assert (rows[20].n_replaced, rows[20].kinds) == (2, "email:2") and rows[3].text is None and rows[1].text == EN
    done = pii.replace(df, b"k")
    assert done.columns == df.columns and done.where("doc_id <> 20 or doc_id is null").exceptAll(df.where("doc_id <> 20 or doc_id is null")).isEmpty()
    assert pii.pseudonyms(none, b"k").count() == 0


# -- 3 ------------------------------------------------------------------------


def test_sentencepiece_equals_the_library(spark, odd, none, sf_dir):
    import sentencepiece

    path = queries.tokenizer_path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(3)
    extra = ["".join(rng.choices(" abc▁\n.,-09é本", k=rng.randint(1, 60))) for _ in range(300)]
    docs = odd.select("doc_id", "text").union(table(spark, sf_dir, "documents").select("doc_id", "text").limit(60)).union(spark.createDataFrame(enumerate(extra), "doc_id long, text string"))
    want = Counter((i, tuple(sp.encode(t or "") if t else [])) for i, t in texts(docs))
    rows = sentencepiece_sa.encode(docs, path)
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows.collect()) == want
    assert Counter((r.doc_id, r.n_ids, r.ids_crc32) for r in sentencepiece_sa.digests(docs, path).collect()) == Counter({(i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())): n for (i, x), n in want.items()})
    back = Counter(texts(sentencepiece_sa.decode(rows, path)))
    assert back == Counter((i, (t or "").replace("▁", " ")) for i, t in texts(docs))
    assert sentencepiece_sa.encode(none, path).count() == 0


def test_sentencepiece_long_units_and_runs_of_spaces():
    import time

    import sentencepiece

    path = queries.tokenizer_path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    c = sentencepiece_sa.Codec(open(path, "rb").read())
    rng = random.Random(33)
    some = [" " * n + w for n in range(1, 70) for w in ("", "the", "本x", "\n", "1", ", a  b", "zq")]
    letters = ["".join(rng.choices("etaoinshrdlucmfwypvbgkjqxzé", k=n)) for n in (5000, 9000, 30_000)] + ["abc" * 5000, "a" * 12_345, "ab" * 7000 + "a" * 9001 + "日" * 300]
    for t in [*some, *letters, "x".join(some), " ".join(letters)]:
        assert np.frombuffer(c.encode([t])[0], "<u2").tolist() == sp.encode(t), t[:80]
    for t in (" " * 1_000_000, "x" + " " * 1_000_001 + "end", "".join(rng.choices("etaoinshrdlu", k=1_000_000))):
        began = time.perf_counter()
        assert np.frombuffer(c.encode([t])[0], "<u2").tolist() == sp.encode(t)
        assert time.perf_counter() - began < 30
    assert c.held <= 2 * sentencepiece_sa.MOST_BYTES


# -- 4 ------------------------------------------------------------------------


def test_warc(spark, sf_dir):
    same(queries.op4_warc(spark, sf_dir), queries.SQL["op4_warc"], sf_dir)
    long = "x" * 200
    rows = [(5, "http://a/ü b\r\nc", long), (3, None, long), (3, "u", long), (None, "u", long), (1, "u", None), (2, "u", "x" * 99), (4, "u", "x" * 99), (9, "u", variety(4, 30_000))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).withColumn("first", F.lit(0))
    got = Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.round_trip(df).collect())
    assert got == Counter([(5, 200, "revisit", 3), (3, 200, "response", None), (3, 200, "response", None), (None, 200, "revisit", 3), (1, 0, "response", None), (2, 99, "response", None), (4, 99, "response", None), (9, len(rows[-1][2]), "response", None)])
    assert warc.round_trip(df.limit(0)).count() == 0


def test_warc_archives_are_checked():
    raw = [warc.record(i, f"http://a/{i}", variety(i, 300).encode(), len(variety(i, 300).encode()), hashlib.sha256(variety(i, 300).encode()).hexdigest(), None, False) for i in range(300)]
    data = warc.archive(raw)
    assert data[:4] == warc.DICT_MAGIC and list(warc.records(data)) == raw
    assert list(warc.records(warc.archive(raw[:2]))) == raw[:2]  # too few for a dictionary
    with pytest.raises(warc.WarcError):
        list(warc.records(data[:-3]))
    for bad in (raw[0][:-1], raw[0].replace(b"WARC/1.1", b"WARC/9.9"), raw[0].replace(b"WARC-Date", b"WARC-Dote"), raw[0].replace(b"Content-Length: ", b"Content-Length: 1", 1)):
        with pytest.raises(warc.WarcError):
            warc.row(bad)
    with pytest.raises(warc.WarcError):
        warc.row(raw[0].replace(b"html; charset=utf-8\r\n", b"html; charset=utf-9\r\n").replace(variety(0, 300).encode()[:3], b"zzz"))


# -- 5 ------------------------------------------------------------------------


def test_token_store(spark, odd, none, sf_dir):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    rng = random.Random(5)
    extra = ["".join(rng.choices(" abc'tsl\n.,-09é×ª½ \t", k=rng.randint(1, 60))) for _ in range(300)]
    docs = odd.select("doc_id", "text").union(table(spark, sf_dir, "documents").select(F.col("doc_id") + 1000, "text")).union(spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(extra)], "doc_id long, text string"))
    store = new_dir(spark, "test-store")
    root = token_store.write_store(docs, path, store)
    rows = token_store.read_store(spark, store, with_ids=True).orderBy("start").collect()
    want = Counter((i, tuple([*tok.encode(t or "", add_special_tokens=False).ids, 2])) for i, t in texts(docs))
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == want
    at = 0
    for r in rows:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes()))
        at += r.n_tokens
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    other = new_dir(spark, "test-store")
    assert token_store.write_store(docs.repartition(3), path, other) == root or len(set(ids)) < len(ids)  # rows that share an id may change places
    assert token_store.encode_to_store(none, path).count() == 0


def test_token_store_notices_damage_and_keeps_chunks_once(spark):
    text = variety(7, 5000)
    docs = spark.createDataFrame([(i, text + (" x" * i if i % 2 else "")) for i in range(20)], "doc_id long, text string").repartition(4)
    store = new_dir(spark, "test-store")
    token_store.write_store(docs, queries.tokenizer_path("byte_bpe_50k.json"), store)
    from pathlib import Path

    packs = list(Path(store.removeprefix("file://")).glob("packs/*"))
    held = sum(p.stat().st_size for p in packs)
    assert held < 3 * len(text)  # twenty copies of it in one and a bit
    raw = bytearray(packs[0].read_bytes())
    raw[len(raw) // 2] ^= 0xFF
    packs[0].write_bytes(bytes(raw))
    with pytest.raises(Exception):  # noqa: B017 - the damage may strike the compressed form or the hash
        token_store.read_store(spark, store).count()


def test_chunk_cuts_depend_on_content():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 50_000, 20_000).astype("<u2")
    moved = np.concatenate([rng.integers(0, 50_000, 777).astype("<u2"), ids])
    one = set(next(token_store.cuts(ids, np.array([0]), np.array([len(ids)]))))
    two = {c - 777 for c in next(token_store.cuts(moved, np.array([0]), np.array([len(moved)])))}
    assert len(one & two) > 0.8 * len(one)


# -- 6 ------------------------------------------------------------------------


def test_decontamination(spark, none):
    rng = random.Random(6)
    vocabulary = variety(8, 3000).split()
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([2, 12, 40])))) for i in range(30)] + [(99, None), (98, ""), (97, "!!!")]
    docs, want = [], set()
    for d in range(120):
        words = rng.choices(vocabulary, k=300)
        if d % 3 == 0:
            i, t = items[d % 30]
            copy = t.split()
            if len(copy) >= 40:  # edited: some words changed, one dropped
                for k in rng.sample(range(len(copy)), 5):
                    copy[k] = "changed"
                del copy[11]
            words[100:100] = [w.upper() if d % 2 else w for w in copy]
            want.add((d, i))
        docs.append((d, " ".join(words) + "."))
    docs += [(500, None), (501, ""), (502, items[2][1]), (502, items[2][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("share", F.lit("clash")).withColumn("c0", F.lit(1))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = Counter((r.doc_id, r.item_id) for r in decontaminate.contaminated(df, bench).collect())
    short = {i for i, t in items if t and len(t.split()) <= 2}
    assert {(d, i) for d, i in want} <= set(got) and got[502, 2] == 2
    assert {x for x in got if x not in want and x[1] not in short} == {(502, 2)}
    left = decontaminate.remove_contaminated(df, bench)
    assert left.columns == df.columns and {r.doc_id for r in left.collect()} == {d for d, _ in docs} - {d for d, _ in got}
    assert decontaminate.contaminated(none, bench).count() == 0 and decontaminate.remove_contaminated(df, bench.limit(0)).count() == df.count()


def test_decontamination_finds_edited_and_partial_copies(spark):
    rng = random.Random(16)
    vocabulary = variety(18, 3000).split()
    items = [(i, " ".join(rng.choices(vocabulary, k=40))) for i in range(30)]
    docs = []
    for i, t in items:
        copy = t.split()
        if i % 3 < 2:  # every 5th or 3rd word replaced
            copy = [rng.choice(vocabulary) if k % (5, 3)[i % 3] == 2 else w for k, w in enumerate(copy)]
        else:  # a half copied, the other from elsewhere
            copy[22:] = rng.choices(vocabulary, k=18)
        words = rng.choices(vocabulary, k=200)
        words[90:90] = copy
        docs.append((i, " ".join(words)))
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(i, i) for i, _ in items}


def test_seeds_lose_no_passage():
    rng = random.Random(26)
    vocabulary = [*"abcdefghijkmnopqrst", *variety(28, 40).split()]
    own = [rng.choices(vocabulary, k=rng.choice([1, 2, 5, 9, 12, 16, 17, 30, 41])) for _ in range(40)]
    items = decontaminate.Items(list(range(40)), [" ".join(w) for w in own])
    texts = []
    for i in [*range(40)] * 8:
        copy, edits = [], rng.random() / 2
        for w in own[i]:
            x = rng.random() / edits if edits else 1
            copy += [w] if x > 1 else ["none"] if x > 0.5 else [w, "none"] if x > 0.25 else []
        texts.append(" ".join([*rng.choices([*vocabulary, "none"], k=30), *copy, *rng.choices([*vocabulary, "none"], k=30)]))
    docs = decontaminate.Texts(texts)
    df, want = items.frequencies(docs), set()
    plain = Counter(g for t in texts for g in {x for n in (1, 2) for x in decontaminate.Texts([t]).grams(n)[1].tolist()})
    assert df.tolist() == [plain[g] for g in items.grams.tolist()]
    windows = [(r, i, s) for r in range(len(texts)) for i, m in enumerate(items.sizes.tolist()) for s in range(0, int(docs.starts[r + 1] - docs.starts[r]), m // 2 + 1)]
    for a in range(0, len(windows), 5000):
        for (r, i, _), score in zip(windows[a : a + 5000], items._align(windows[a : a + 5000], docs), strict=True):
            m = int(items.sizes[i])
            if score >= max(decontaminate.MIN_SHARE * decontaminate.MATCH * m, decontaminate.MATCH * min(m, decontaminate.SHORT)):
                want.add((r, i))
    items.keep_rare(df)
    assert {(r, i) for r, i, _ in items.matches(docs)} == want


def test_alignment_against_plain_dynamic_programming():
    rng = random.Random(7)
    items = decontaminate.Items(list(range(8)), [" ".join(rng.choices("abcdefghijk", k=rng.randint(3, 25))) for _ in range(8)])
    docs = decontaminate.Texts(" ".join(rng.choices("abcdefghijkxyz", k=rng.randint(1, 60))) for _ in range(8))
    windows = [(r, i, 0) for r in range(8) for i in range(8)]
    for (r, i, _), got in zip(windows, items._align(windows, docs), strict=True):
        m = int(items.sizes[i])
        a = items.texts.hashes[items.texts.starts[i] : items.texts.starts[i + 1]]
        b = docs.hashes[docs.starts[r] : docs.starts[r + 1]][: 2 * m + 2]
        assert got == plain_alignment(a, b).max()


def plain_alignment(a, b):
    """All local scores of two sequences, by plain dynamic programming."""
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for x in range(1, len(a) + 1):
        for y in range(1, len(b) + 1):
            s = decontaminate.MATCH if a[x - 1] == b[y - 1] else decontaminate.MISMATCH
            h[x, y] = max(0, h[x - 1, y - 1] + s, h[x - 1, y] + decontaminate.GAP, h[x, y - 1] + decontaminate.GAP)
    return h


def test_decontamination_of_all_documents_against_all_alignments(spark):
    """Every item of sf0.01 against every whole document, without seeds: none is missed, none is made up."""
    sf = "/root/testdata/sf0.01"
    docs, bench = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    got = {(r.doc_id, r.item_id): r.share for r in decontaminate.contaminated(docs, bench).collect()}
    items = decontaminate.Items(*map(list, zip(*((r.item_id, r.text) for r in bench.collect()), strict=True)))
    want = {}
    for doc_id, text in texts(docs):
        one = decontaminate.Texts([text])
        size = int(one.starts[1])
        for i, m in enumerate(items.sizes.tolist()):
            # an item whose words, repeats counted, cover too little of it can't reach the score
            a = items.texts.hashes[items.texts.starts[i] : items.texts.starts[i + 1]]
            if 2 * np.isin(a, one.hashes).sum() < max(decontaminate.MIN_SHARE * decontaminate.MATCH * m, decontaminate.MATCH * min(m, decontaminate.SHORT)):
                continue
            starts = [(0, i, s) for s in range(0, size, m // 2 + 1)]
            best = max((max(items._align(starts[k : k + 500], one)) for k in range(0, len(starts), 500)), default=0)
            if best >= max(decontaminate.MIN_SHARE * decontaminate.MATCH * m, decontaminate.MATCH * min(m, decontaminate.SHORT)):
                want[doc_id, items.ids[i]] = best / (decontaminate.MATCH * m)
    assert len(want) >= 20 and set(got) == set(want) and all(abs(got[k] - want[k]) < 0.2 for k in want)


def test_decontamination_in_blocks_and_of_long_items(spark, monkeypatch):
    rng = random.Random(36)
    vocabulary = variety(38, 3000).split()
    items = [(i, " ".join(rng.choices(vocabulary, k=30))) for i in range(40)] + [(99, " ".join(rng.choices(vocabulary, k=6000)))]
    docs = [(d, " ".join([*rng.choices(vocabulary, k=80), *items[d][1].split(), *rng.choices(vocabulary, k=80)])) for d in range(0, 41, 3)] + [(100, items[40][1]), (101, None)]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = {(d, d) for d in range(0, 39, 3)} | {(39, 39), (100, 99)}
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(df, bench).collect()} == want
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 1000)
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(df, bench).collect()} == want
    assert {r.doc_id for r in decontaminate.remove_contaminated(df, bench).collect()} == {101}
    assert decontaminate.contaminated(df, bench)._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1  # one pass besides that for the counts


# -- 7 ------------------------------------------------------------------------


def test_language(spark, odd, none, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(odd.where("doc_id is not null")).collect()}
    assert [got[i] for i in (3, 4, 5, 6)] == [("und", 0.0)] * 4 and got[7][0] == "en" and len(got) == 11
    assert langid.identify(odd).count() == odd.count() and langid.identify(none).count() == 0
    assert {r.lang_pred for r in langid.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    kept = langid.keep_identified(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()}.isdisjoint({3, 4, 5, 6})


def test_language_does_not_depend_on_neighbours():
    a = langid.Model(["de", "en"], np.random.default_rng(1).normal(size=(2, langid.BUCKETS + 1)).astype(np.float32), np.log([0.5, 0.5]))
    a.table[:, langid.BUCKETS] = 0
    some = [EN, "", DE, "x", "1 2", "İi", EN[:7]]
    many = a.score(some)
    for k, t in enumerate(some):
        one = a.score([t])
        assert one[0][0] == many[0][k] and abs(one[1][0] - many[1][k]) < 1e-9


def plain_bayes(train, texts_):
    """Multinomial naive Bayes over hashed 1- to 3-grams by loops and dictionaries."""
    import math

    def grams(t):
        low = [ord(c) if c.isalpha() else 32 for c in "  " + t.lower() + "  "]
        for i in range(len(low) - 2):
            h = 0
            for k in range(3):
                h = (h * 0x01000193 + low[i + k] * 0x9E3779B1 + k + 1) & 0xFFFFFFFF
                if any(c != 32 for c in low[i : i + k + 1]):
                    yield (((h ^ h >> 15) * 0x85EBCA77) & 0xFFFFFFFF) >> 17

    counts, docs = {}, Counter()
    for lang, t in set(train):
        docs[lang] += 1
        counts.setdefault(lang, Counter()).update(grams(t))
    total = {k: sum(c.values()) + 0.1 * (1 << 15) for k, c in counts.items()}
    for t in texts_:
        found = Counter(grams(t))
        if not any(c.isalpha() for c in t):
            yield "und", 0.0
            continue
        n = sum(found.values())
        log = {k: (math.log(docs[k] / sum(docs.values())) + sum(m * math.log((counts[k][g] + 0.1) / total[k]) for g, m in found.items())) * 64 / max(n, 64) for k in sorted(counts)}
        best = max(log, key=log.get)
        yield best, 1 / sum(math.exp(x - log[best]) for x in log.values())


def test_language_against_plain_bayes(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").collect()
    got = {r.doc_id: r for r in langid.identify(table(spark, sf_dir, "documents")).collect()}
    train = [(r.lang, r.text) for r in docs if r.lang is not None and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1]
    for r, (lang, score) in zip(docs, plain_bayes(train, [r.text or "" for r in docs]), strict=True):
        assert got[r.doc_id].lang_pred == lang and abs(got[r.doc_id].score - score) < 1e-4


# -- 8 ------------------------------------------------------------------------


def plain_statistics(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    c, covered, seen, again = Counter(zip(w, w[1:], w[2:], strict=False)), set(), set(), 0
    for k in range(len(w) - 2):
        if c[tuple(w[k : k + 3])] > 1:
            covered |= {k, k + 1, k + 2}
    for line in (t or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    n = len(covered)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), again, n, len(w) < 50 or 100 * n > 50 * len(w)


def test_quality_statistics(spark, odd, sf_dir):
    rng = random.Random(8)
    extra = spark.createDataFrame([(2000 + i, "".join(rng.choices(["a ", "b ", "c\n", "a b c ", "\x0b", "# ", "é😀 "], k=rng.randint(0, 120))), "x", "y", 0) for i in range(150)], DOCS)
    docs = odd.select(*extra.columns).unionByName(extra).unionByName(table(spark, sf_dir, "documents"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = Counter((r.doc_id, *(r[c] for c in names)) for r in quality_rules.base(docs).collect())
    assert got == Counter((i, *plain_statistics(t)) for i, t in texts(docs))


def test_quality_outliers(spark, odd, none, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows = quality_rules.judge(docs).join(labels, "doc_id").collect()
    passed = [r for r in rows if not r.base_failed]
    assert all(r.kept for r in passed if r.quality == 1)
    assert np.mean([not r.kept for r in passed if r.quality == 0]) > 0.8
    assert quality_rules.judge(odd).count() == odd.count() and quality_rules.judge(none).count() == 0


def plain_mcd(x, starts=60):
    """Least determinant of a covariance of SUPPORT of the rows that concentration steps from random starts lead to, with floors as in the operator."""
    rng, floor, h = np.random.default_rng(1), np.array(list(quality_rules.FLOORS.values())) ** 2, int(np.ceil(quality_rules.SUPPORT * len(x)))
    best = (np.inf, None, None)
    for _ in range(starts):
        rows = rng.choice(len(x), 12, replace=False)
        last = np.inf
        while True:
            m, c = x[rows].mean(0), quality_rules.CONSISTENCY * np.cov(x[rows].T, bias=True) + np.diag(floor)
            logdet = np.linalg.slogdet(c)[1]
            if logdet > last - 1e-9 and len(rows) == h:
                break
            last = logdet if len(rows) == h else np.inf
            if last < best[0]:
                best = (last, m, c)
            d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
            rows = np.argsort(d, kind="stable")[:h]
    return best


def test_covariance_determinant_against_plain_search(spark):
    rng = np.random.default_rng(8)
    parts = []
    for k in range(3):
        a = rng.normal(size=(5, 5)) * 0.5
        x = rng.multivariate_normal([6, 1.6, 0, 0, 0], a @ a.T + 0.05 * np.eye(5), 700)
        x[: 100 + 40 * k] += [[0, 0, 6, 0, 5], [3, 0, 0, 6, 0], [-4, 2, 0, 0, 6]][k]
        parts.append(np.round(x * 1024) / 1024)
    df = spark.createDataFrame([(f"g{k}", *map(float, v)) for k, x in enumerate(parts) for v in x], "g string, " + ", ".join(f"{k} double" for k in quality_rules.NAMES))
    model = quality_rules.estimates(df, 3)
    found = {r.g: r for r in model.collect()}
    dist = {}
    for r in quality_rules.with_distance(quality_rules._joined(df, model, ["g"])).collect():
        dist.setdefault(r.g, {})[tuple(r[k] for k in quality_rules.NAMES)] = r.d2
    for k, x in enumerate(parts):
        logdet, m, c = plain_mcd(x)
        r = found[f"g{k}"]
        assert abs(r.logdet - logdet) < 0.1, (k, r.logdet, logdet)
        assert np.allclose([r[f"m{i}"] for i in range(5)], m, atol=0.15)
        want = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
        got = np.array([dist[f"g{k}"][tuple(map(float, v))] for v in x])
        assert np.median(np.abs(got / want - 1)) < 0.1
        assert ((got > 20.5) == (want > 20.5)).mean() > 0.98 and (got[: 100 + 40 * k] > 20.5).mean() > 0.98


def test_repeats_alone_can_reject(spark):
    words = [variety(500 + d, 300).split() for d in range(150)]
    docs = [(d, " ".join(w), "xx", "s", 1) for d, w in enumerate(words)]
    half = words[0][:230] + words[0][160:230]  # nothing else is unusual
    rows = {r.doc_id: r for r in quality_rules.judge(spark.createDataFrame([*docs, (999, " ".join(half), "xx", "s", 1)], DOCS)).collect()}
    assert all(r.kept for i, r in rows.items() if i != 999) and not rows[999].base_failed and not rows[999].kept


# -- 9 ------------------------------------------------------------------------


def test_importance(spark, odd, none, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows = importance.resample(docs, labels, 0.7).collect()
    assert sum(r.kept for r in rows) == 140
    best = sorted(rows, key=lambda r: (-r["rank"], r.doc_id))[:140]
    assert {r.doc_id for r in best} == {r.doc_id for r in rows if r.kept}
    by = {r.doc_id: r for r in rows}
    good, bad = ([by[r.doc_id].log_weight for r in labels.where(f"quality = {q}").collect() if r.doc_id in by] for q in (1, 0))
    assert np.mean(good) > np.mean(bad) + 50
    assert [r.log_weight for r in importance.resample(odd, labels.limit(0)).collect()] == [0.0] * odd.count()
    assert importance.resample(none, labels).count() == 0


def test_importance_weights_against_plain_counting(spark, sf_dir):
    import math

    docs, labels = table(spark, sf_dir, "documents").collect(), table(spark, sf_dir, "labels").collect()
    good = {r.doc_id for r in labels if r.quality == 1}
    mask = (1 << 64) - 1

    def buckets(t):
        h = [zlib.crc32(x.encode()) for x in re.findall(r"\w+|[^\w\s]+", (t or "").lower())]
        for x in [2 * a + 1 for a in h] + [(a * 0x9E3779B97F4A7C15 & mask) ^ (b * 0xC2B2AE3D27D4EB4F & mask) for a, b in zip(h, h[1:], strict=False)]:
            yield (x * 0xD6E8FEB86659FD93 & mask) >> 50

    raw, target = Counter(), Counter()
    for r in docs:
        raw.update(buckets(r.text))
        if r.doc_id in good:
            target.update(buckets(r.text))
    n, m = sum(raw.values()), sum(target.values())
    share = lambda c, size, b: (c[b] + size / max(n, m)) / (size + (1 << 14) * size / max(n, m))
    got = {r.doc_id: r.log_weight for r in importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).collect()}
    for r in docs:
        want = sum(math.log(share(target, m, b)) - math.log(share(raw, n, b)) for b in buckets(r.text))
        assert abs(got[r.doc_id] - want) < 1e-6 * max(1, abs(want))


def test_top_is_exact(spark):
    rng = random.Random(9)
    rows = [(rng.choice([rng.randint(-50, 50), rng.randint(-(1 << 40), 1 << 40)]), rng.choice([None, *range(9)])) for _ in range(500)]
    df = spark.createDataFrame(rows, "rank long, doc_id long")
    order = sorted(rows, key=lambda r: (-r[0], r[1] is not None, r[1] or 0))
    for k in (0, 1, 3, 250, 500):
        got = Counter(map(tuple, df.where(importance.top(df, k)).collect()))
        want = [r for r in rows if k and (-r[0], r[1] is not None, r[1] or 0) <= (-order[k - 1][0], order[k - 1][1] is not None, order[k - 1][1] or 0)]
        assert got == Counter(want)


# -- 10 -----------------------------------------------------------------------


def plain_similarity(a, b):
    """Longest common subsequence of two lists over both taken together, by plain dynamic programming over numpy rows."""
    before = np.zeros(len(b) + 1, int)
    codes = {w: k for k, w in enumerate(dict.fromkeys(a + b))}
    y = np.array([codes[w] for w in b])
    for w in a:
        now = before.copy()
        now[1:] = np.maximum(before[1:], before[:-1] + (y == codes[w]))
        before = np.maximum.accumulate(now)
    return before[-1] / (len(a) + len(b) - before[-1])


def plain_classes(docs):
    """Least id of each connected class of texts whose words are alike, all pairs compared."""
    texts_ = sorted({" ".join((t or "").lower().split()) for _, t in docs} - {""})
    own = [t.split() for t in texts_]
    root = list(range(len(texts_)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(own)):
        for j in range(i):
            if min(len(own[i]), len(own[j])) >= 0.8 * max(len(own[i]), len(own[j])) and plain_similarity(own[i], own[j]) >= 0.8:
                root[find(i)] = find(j)
    place = {t: find(k) for k, t in enumerate(texts_)}
    least = {}
    for i, t in docs:
        c = place.get(" ".join((t or "").lower().split()))
        if c is not None and i is not None:
            least[c] = min(i, least.get(c, i))
    return Counter((i, least[place[k]] if (k := " ".join((t or "").lower().split())) else i) for i, t in docs)


def test_near_duplicates_against_all_pairs(spark):
    rng, docs = random.Random(10), []
    for g in range(12):
        base = variety(100 + g, rng.randint(6, 120)).split()
        for _ in range(rng.randint(1, 5)):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                words[rng.randrange(len(words))] = variety(rng.randrange(1 << 30), 1)
            docs.append((len(docs), (" ".join(words)).upper() if rng.random() < 0.2 else "  ".join(words)))
    docs += [(100, "a b"), (101, "a  B"), (102, "a"), (103, None), (104, ""), (105, " \n")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert Counter((r.doc_id, r.class_id) for r in near_dup.groups(df).collect()) == plain_classes(docs)


def edited(rng, words, n, even):
    """words with n of them replaced by new ones, at even steps or anywhere."""
    at = [int((k + 0.5) * len(words) / n) for k in range(n)] if even else rng.sample(range(len(words)), n)
    return [f"new{rng.randrange(1 << 40)}" if k in set(at) else w for k, w in enumerate(words)]


def test_near_duplicates_at_the_threshold(spark):
    """Of 200 planted pairs of each size, similarity and way of editing nine tenths at least share a class."""
    rng, docs, kinds = random.Random(20), [], {}
    for size, n in ((9, 1), (18, 2), (45, 5), (45, 4), (180, 20), (180, 16), (900, 100), (900, 78)):
        for even in (True, False):
            for _ in range(200):
                words = [f"w{rng.randrange(1 << 40)}" for _ in range(size)]
                kinds[len(docs)] = (size, n, even)
                docs += [(len(docs), " ".join(words)), (len(docs) + 1, " ".join(edited(rng, words, n, even)))]
    for _ in range(200):  # a word put into four
        words = [f"w{rng.randrange(1 << 40)}" for _ in range(5)]
        out = rng.randrange(5)
        kinds[len(docs)] = (4, 1, None)
        docs += [(len(docs), " ".join(words)), (len(docs) + 1, " ".join(w for k, w in enumerate(words) if k != out))]
    classes = {r.doc_id: r.class_id for r in near_dup.groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    found = Counter(kind for d, kind in kinds.items() if classes[d + 1] == d)
    assert {kind: n for kind, n in found.items() if n < 180} == {} and len(found) == 17


@pytest.mark.parametrize("block", [near_dup.BLOCK_BYTES, 200_000])
def test_near_duplicates_within_a_template(spark, monkeypatch, block):
    monkeypatch.setattr(near_dup, "BLOCK_BYTES", block)
    vocabulary = variety(41, 4000).split()
    rng = random.Random(42)
    template = rng.choices(vocabulary, k=350)
    docs = []
    for d in range(200):  # siblings at 0.77; those from 120 on have a partner at 0.81
        own = rng.choices(vocabulary, k=52)
        docs.append((d, " ".join(template + own)))
        if d >= 120:
            docs.append((d + 1000, " ".join(template + own[:14] + rng.choices(vocabulary, k=38))))
    got = {r.doc_id: r.class_id for r in near_dup.groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {d: d if d < 1000 else d - 1000 for d, _ in docs}


def test_chains_of_near_copies_stay_whole(spark):
    """Each text is a copy of the one before with an edit; no class may come apart, however far its ends are."""
    docs = []
    for seed in range(2):
        rng, words = random.Random(70 + seed), variety(80 + seed, 60).split()
        for k in range(120):
            docs.append((seed * 1000 + k, " ".join(words)))
            for _ in range((1, 3)[seed % 2]):
                words[rng.randrange(len(words))] = variety(rng.randrange(1 << 30), 1)
    got = {r.doc_id: r.class_id for r in near_dup.groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {d: d // 1000 * 1000 for d, _ in docs}


def test_components_of_random_graphs(spark):
    from broadleaf.llm.common import Scratch

    rng = random.Random(45)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + (k * 37) % 101, 1000 + (k * 37 + 37) % 101) for k in range(90)]
    root = {x: x for e in links for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want = {x: find(x) for x in root}
    scratch = Scratch(spark, "test")
    one, two = (spark.createDataFrame(x, "a long, b long") for x in (links[:150], links[150:]))
    labels = near_dup.joined(near_dup.joined(None, one, 150, scratch), two, len(links) - 150, scratch)
    got = {r.node: r.label for r in labels.collect()}
    assert {x: got.get(x, x) for x in want} == want and labels.count() == len(got)
    scratch.clear()


def test_near_duplicate_recall_on_documents(spark):
    """Links found or implied, of all pairs of different texts of sf0.01 that are links; pairs come from an index of all shingles."""
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = near_dup.classes(docs).select("node", "class").distinct().collect()
    label = {r.node: r["class"] for r in rows}
    words = {}
    for (t,) in docs.select("text").distinct().collect():
        node, h = near_dup.words(t)
        words[int(np.uint64(node).view(np.int64))] = h
    index = {}
    for node, h in words.items():
        for x in set(near_dup.shingles(h).tolist()):
            index.setdefault(x, []).append(node)
    near = Counter((a, b) for some in index.values() for k, a in enumerate(some) for b in some[:k])
    links = [p for p in near if len(words[p[0]]) and min(len(words[x]) for x in p) >= 0.8 * max(len(words[x]) for x in p) and near_dup.similarity(words[p[0]], words[p[1]]) > 0]
    found = sum(label[a] == label[b] for a, b in links)
    assert len(links) > 50 and found == len(links)
    assert all(len({a, b}) == 2 for a, b in links)


def test_long_texts_are_aligned_in_bounded_memory():
    import tracemalloc

    rng = np.random.default_rng(44)
    a = rng.integers(0, 30_000, 60_000).astype(np.uint32)
    b = np.concatenate([[7_000_001], a[1:20_000], rng.integers(0, 30_000, 300), a[20_200:-1], [7_000_002]]).astype(np.uint32)
    tracemalloc.start()
    found = near_dup.similarity(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 0.98 < found < 1 and peak < 60 << 20


def test_overlaps_count_common_values():
    rng = np.random.default_rng(43)
    arrays = [rng.integers(0, m, 60).astype(np.uint32) for m in (20, 100, 400, 3000) for _ in range(12)]
    got = near_dup.overlaps(arrays)
    for i, a in enumerate(arrays):
        for j, b in enumerate(arrays):
            assert i == j or sum((Counter(a.tolist()) & Counter(b.tolist())).values()) == got[i, j]


def test_alignment_and_bounds():
    rng = random.Random(11)
    for _ in range(300):
        a = [rng.randrange(6) for _ in range(rng.randint(1, 30))]
        b = list(a) if rng.random() < 0.5 else [rng.randrange(6) for _ in range(rng.randint(1, 30))]
        for _ in range(rng.randint(0, 4)):
            b[rng.randrange(len(b))] = rng.randrange(6)
        n = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                n[i + 1, j + 1] = n[i, j] + 1 if x == y else max(n[i, j + 1], n[i + 1, j])
        assert near_dup.common(a, b, 99) == near_dup.common_within(a, b, 99) == n[-1, -1]
        assert near_dup.common(a, b, 2) == near_dup.common_within(a, b, 2)
        want = n[-1, -1] / (len(a) + len(b) - n[-1, -1])
        assert near_dup.similarity(np.array(a, np.uint32), np.array(b, np.uint32)) == (want if want >= 0.8 else 0.0)


def test_deduplicate_keeps_one_of_each_class(spark, odd, none):
    left = near_dup.deduplicate(odd)
    assert left.columns == odd.columns
    got = Counter(" ".join((t or "").lower().split()) for _, t in texts(left))
    want = {" ".join((t or "").lower().split()) for _, t in texts(odd)}
    assert set(got) == want - {" ".join((EN + " with one more").split())} and all(n == 1 for t, n in got.items() if t)
    assert got[""] == sum(not (t or "").split() for _, t in texts(odd))  # wordless texts are no copies
    assert near_dup.deduplicate(none).count() == 0 and near_dup.groups(none).count() == 0


def test_sketches_tell_order_apart():
    h = near_dup.shingles(near_dup.words(variety(12, 400))[1])
    assert (near_dup.sketches(h) == near_dup.sketches(h.copy())).all()
    assert (near_dup.sketches(h) != near_dup.sketches(h[::-1].copy())).mean() > 0.9
    again = np.append(h, h[5])  # a repeat elsewhere leaves most values as they are
    assert (near_dup.sketches(h) == near_dup.sketches(again)).mean() > 0.9


# -- the pipeline ----------------------------------------------------------------


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    out = corpus_pipeline.run(spark, sf_dir).collect()
    assert len({r.doc_id for r in out}) == len(out) and all(r.restored for r in out)
    classes = {r.class_id for r in near_dup.groups(table(spark, sf_dir, "documents")).collect()}
    leaks = {r.doc_id for r in decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).collect()}
    unknown = {r.doc_id for r in langid.identify(table(spark, sf_dir, "documents")).where("lang_pred = 'und' or score < 0.5").collect()}
    assert {r.doc_id for r in out} == classes - leaks - unknown


def test_filters_keep_column_names(spark):
    df = spark.createDataFrame([(1, "a")], "`x.y` int, t string")
    assert keep_texts(df, "t", lambda texts: [True] * len(texts)).columns == ["x.y", "t"]


def test_blocks_meet_once_and_are_sent_for_several(spark):
    """Each two blocks alike in size meet once; a block is sent fewer than 0.7 times as often as it meets."""
    n = 24
    blocks = spark.createDataFrame([(1, k, 10, 10, k, k + 1) for k in range(n)] + [(2, 0, 5, 5, 1, 1)], "unit long, blk long, lo long, hi long, `from` long, `to` long")
    places = near_dup._meetings(blocks).collect()
    assert {p.unit for p in places} == {1}
    met = [(p.blk1, p.blk) for p in places if p.blk != p.blk1]
    assert sorted(met) == [(i, j) for i in range(n) for j in range(i + 1, n)]
    assert {(p.blk1, p.blk) for p in places if p.chunk == 0} >= {(k, k) for k in range(n)}
    assert len(places) < 0.7 * n * n


def test_words_in_common_of_the_first_arrays():
    rng = np.random.default_rng(4)
    arrays = [rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint32) for _ in range(40)]
    whole = near_dup.overlaps(arrays)
    count = lambda a, b: sum(min((a == v).sum(), (b == v).sum()) for v in np.unique(a))
    assert all(whole[i, j] == count(arrays[i], arrays[j]) for i in range(40) for j in range(40) if i != j)
    part = near_dup.overlaps(arrays, 7)
    assert part.shape == (7, 40) and all(part[i, j] == whole[i, j] for i in range(7) for j in range(40) if i != j)
