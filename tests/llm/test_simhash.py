"""op13 against all pairs and a plain fingerprint, with any scheme, tiny blocks and odd rows."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from broadleaf.llm import queries, simhash
from broadleaf.llm.common import table


def plain_fingerprint(text):
    lower = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_classes(rows):
    """doc_id, fingerprint, least doc_id reachable, of rows with unique ids."""
    prints = [(d, plain_fingerprint(t)) for d, t in rows]
    x = np.array(sorted({p for _, p in prints}), np.uint64)
    label = np.arange(len(x))
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= 3
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            break
        label = new
    at = {int(v): int(c) for v, c in zip(x, label, strict=True)}
    least = {}
    for d, p in prints:
        least[at[p]] = min(d, least.get(at[p], d))
    return sorted((d, f"{p:016x}", least[at[p]]) for d, p in prints)


def got(df):
    return sorted(tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect())


def family(rng, n):
    """Texts that differ in few places, so that many fingerprints lie near each other."""
    base = [rng.choice(["alpha", "beta", "gamma", "delta", "omega", "kappa"]) + str(rng.randrange(40)) for _ in range(300)]
    out = []
    for k in range(n):
        words = list(base)
        for _ in range(k % 5):
            words[rng.randrange(300)] = f"new{rng.randrange(1000)}"
        out.append(" ".join(words))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    texts = family(rng, 150) + family(rng, 60) + ["", " \t\x0b\n", "One", "one two", "ONE  TWO\n", "one two three", "É é ß x y z w", "日本 語 テスト", "word " * 50_000, "x" * 100_000]
    texts += [" ".join(str(rng.random()) for _ in range(rng.randrange(1, 40))) for _ in range(100)]
    return [(k + 3, t) for k, t in enumerate(texts)] + [(1, None)]


SCHEMES = [None, [(list(range(0, 32)), 1), (list(range(32, 64)), 1)], [(list(range(0, 16)), 2), (list(range(16, 40)), 0)], [(list(range(k, 64, 4)), 0) for k in range(4)]]


@pytest.mark.parametrize("k", range(len(SCHEMES)))
def test_any_scheme_finds_all_links(spark, rows, k):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("clash")).withColumn("key", F.lit(1)).repartition(5)
    wanted = plain_classes(rows)
    assert len({c for *_, c in wanted}) < len({p for _, p, _ in wanted}) - 50
    assert got(simhash.groups(df, parts=SCHEMES[k], block=7, largest=20 if k else simhash.LARGEST)) == wanted


def test_odd_rows(spark):
    rows = [(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (None, "q r s t u"), (9, None), (None, None), (4, "A B c d")]
    found = {(r.doc_id, r.component_id) for r in simhash.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {(5, 4), (None, 4), (None, None), (9, 9), (None, 9), (4, 4)}
    assert simhash.groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_all_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    assert got(queries.op13_simhash(spark, sf_dir)) == plain_classes([(r.doc_id, r.text) for r in docs.collect()])


def test_scheme_is_complete_and_uneven():
    rng = np.random.default_rng(1)
    half = rng.integers(0, 2, (4000, 64))
    half[:, :30] = half[:, :1]  # thirty bits that go together
    sample = (half.astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    for n in (4000, 10**6, 10**10):
        parts = simhash.scheme(sample, n)
        assert sum(t + 1 for _, t in parts) == simhash.DISTANCE + 1
        bits = [b for own, _ in parts for b in own]
        assert len(bits) == len(set(bits)) <= 64
    groups = simhash.bit_groups((sample[:, None] >> np.arange(64, dtype=np.uint64) & np.uint64(1)).astype(float), 4)
    assert sorted(b for g in groups for b in g) == list(range(64)) and any(set(g) <= set(range(30)) for g in groups)
