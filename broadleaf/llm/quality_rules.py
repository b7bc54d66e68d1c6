"""Quality rules: fixed base rules, then robust multivariate outliers.

Per text, in built-in functions: words (runs of other than space and U+0009 to
U+000D), their characters, symbols, repeated lines, and words in three-word
windows that occur more than once.  Texts that pass the base rules become
vectors of transformed statistics.  For each language and source a minimum
covariance determinant estimate is found by concentration steps: the SUPPORT share
of texts that is nearest by Mahalanobis distance gives the next mean and covariance.
There are three starts, all robust and none random: medians with median deviations,
and those deviations with the correlations of the tanh and of the spatial signs of
the standardised statistics.  Each start steps on as long as its determinant falls
by more than LEAST_FALL of its logarithm; of the three the least determinant is the
group's estimate.  A step is one aggregation: texts are counted and summed by
distance bin, the bins of the nearest texts are summed, and the Cholesky factor of
their covariance is written out in columns.  The last bin, a 32nd of an octave of
distance, is taken whole.  Texts beyond CUTOFF are rejected.

Groups of fewer than LEAST_GROUP texts use their language's estimate, or the
whole table's.  Sums are of multiples of 1/1024, hence exact and the same in any
order up to some 30 million texts a group.

Defined results: null text has no words and fails the base rules; null language
or source is a group of its own; an empty table gives no rows; repeated rows
each get a row; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import broadcast_if_small, written

SPACES, SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SUPPORT, LEAST_GROUP, LEAST_FALL = 0.75, 100, 1e-3
#: Statistics and the least standard deviation that counts for each: exact zeros in a group don't make a single symbol an outlier.
FLOORS = {"x_words": 0.5, "x_length": 0.1, "x_symbols": 0.5, "x_lines": 0.5, "x_repeats": 0.6}
NAMES = tuple(FLOORS)
#: Fixed values for five statistics: SUPPORT over the chi-square distribution (7 degrees) at its SUPPORT quantile for 5 degrees.
CONSISTENCY = 1.41
CUTOFF = 40.0
UNIT, BINS_PER_OCTAVE, MOST_BIN = 1024, 32, 640
GROUP_ROW_BYTES = 600


def _without(text: Column, chars: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c))
    return text


def base(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", by: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """doc_id, the two group columns as g1 and g2, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    rows = docs.select(F.col(id_col).alias("doc_id"), *(F.col(c).cast("string").alias(g) for c, g in zip(by, ("g1", "g2"), strict=True)), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    chars = F.char_length("t")
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    rows = rows.select(
        "doc_id", "g1", "g2",
        F.char_length(_without(F.col("t"), SPACES)).cast("long").alias("word_chars"),
        (chars - F.char_length(_without(F.col("t"), SYMBOLS))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.filter(F.split("t", r"[ \t-\r]+"), lambda x: x != "").alias("w"),
    )
    rows = rows.withColumn("n", F.size("w")).withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")).drop("lines")
    w = F.col("w")
    windows = F.when(F.col("n") >= 3, F.transform(F.sequence(F.lit(0), F.col("n") - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))).otherwise(F.array().cast("array<long>"))
    rows = rows.withColumn("h", windows).drop("w")
    pairs = F.when(F.size(F.array_distinct("h")) < F.size("h"), F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    rows = rows.withColumn("s", pairs).drop("h").withColumn("m", F.size("s"))
    s, m = F.col("s"), F.col("m")
    twice = F.filter("s", lambda x, k: ((k > 0) & (s[F.greatest(k - 1, F.lit(0))]["h"] == x["h"])) | ((k < m - 1) & (s[F.least(k + 1, m - 1)]["h"] == x["h"])))
    rows = rows.withColumn("p", F.sort_array(F.transform(twice, lambda x: x["i"]))).drop("s", "m").withColumn("k", F.size("p"))
    p, k = F.col("p"), F.col("k")
    covered = F.aggregate(F.transform("p", lambda x, j: F.when(j < k - 1, F.least(F.lit(3), p[F.least(j + 1, k - 1)] - x)).otherwise(3)), F.lit(0), lambda a, x: a + x)
    rows = rows.select("doc_id", "g1", "g2", F.col("n").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", covered.cast("long").alias("n_repeat_words"))
    return rows.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def vectors(stats: DataFrame) -> DataFrame:
    """stats with the transformed statistics, as multiples of 1 / UNIT."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    x = {
        "x_words": F.log1p(n),
        "x_length": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        "x_symbols": F.log1p(100 * F.col("n_symbols") / n),
        "x_lines": F.log1p(100 * F.col("n_dup_lines") / n),
        "x_repeats": F.log1p(100 * F.col("n_repeat_words") / n),
    }
    return stats.withColumns({k: F.round(v * UNIT) / UNIT for k, v in x.items()})


def _groups(rows: DataFrame) -> DataFrame:
    """g1, g2 and the name g of the group whose estimate they use."""
    n = rows.groupBy("g1", "g2").agg(F.count("*").alias("n"))
    n = n.withColumn("n1", F.sum("n").over(W.partitionBy("g1")))
    one = F.concat_ws("\x1f", F.coalesce("g1", F.lit("\x1e")))
    return n.select("g1", "g2", F.when(F.col("n") >= LEAST_GROUP, F.concat_ws("\x1f", one, F.coalesce("g2", F.lit("\x1e")))).when(F.col("n1") >= LEAST_GROUP, one).otherwise("").alias("g"))


def _joined(rows: DataFrame, side: DataFrame, keys: list[str], n: int | None = None) -> DataFrame:
    """rows with the columns of a side of n rows, a few for each group; null keys meet."""
    side = broadcast_if_small(side, GROUP_ROW_BYTES, n)
    renamed = side.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return rows.join(renamed, on).drop(*(f"_{k}" for k in keys))


def _medians(rows: DataFrame, value: dict[str, Column], names: tuple[str, ...]) -> DataFrame:
    """The median of each value by g, to within 1 / 64: from counts by bin."""
    pairs = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.floor(v * 64).alias("b")) for k, v in value.items())))
    counts = rows.select("g", pairs.alias("e")).select("g", "e.*").groupBy("g", "k", "b").count()
    by = W.partitionBy("g", "k")
    counts = counts.withColumn("below", F.sum("count").over(by.orderBy("b"))).withColumn("all", F.sum("count").over(by))
    half = counts.where("2 * below >= all").groupBy("g", "k").agg(((F.min("b") + 0.5) / 64).alias("m"))
    return half.groupBy("g").agg(*(F.max(F.when(F.col("k") == k, F.col("m"))).alias(out) for k, out in zip(value, names, strict=True)))


def _factor(out: DataFrame, c) -> DataFrame:
    """out with the Cholesky factor l00.. of the covariance c(i, j), and logdet, the logarithm of its determinant."""
    p = range(len(NAMES))
    for j in p:
        rest = {i: c(i, j) - sum((F.col(f"l{i}{t}") * F.col(f"l{j}{t}") for t in range(j)), F.lit(0.0)) for i in p[j:]}
        out = out.withColumn(f"l{j}{j}", F.sqrt(F.greatest(rest.pop(j), F.lit(1e-6))))
        out = out.withColumns({f"l{i}{j}": v / F.col(f"l{j}{j}") for i, v in rest.items()})
    return out.withColumn("logdet", 2 * sum((F.log(f"l{i}{i}") for i in p[1:]), F.log("l00")))


def _model_columns() -> list[str]:
    p = range(len(NAMES))
    return ["g", "s", *(f"m{i}" for i in p), *(f"l{i}{j}" for i in p for j in range(i + 1)), "logdet"]


def _starts(rows: DataFrame, n: int) -> DataFrame:
    """By g and s, the start: centre m0.. of medians, a Cholesky factor l00.. and its logdet."""
    p = range(len(NAMES))
    m = written(_medians(rows, {k: F.col(k) for k in NAMES}, tuple(f"m{i}" for i in p)), "medians")
    near = _joined(rows, m, ["g"], n)
    d = written(_medians(near, {k: F.abs(F.col(k) - F.col(f"m{i}")) for i, k in enumerate(NAMES)}, tuple(f"d{i}" for i in p)), "deviations")
    scales = written(m.join(d, "g").select("g", *(f"m{i}" for i in p), *(F.greatest(F.lit(1.4826) * F.col(f"d{i}"), F.lit(FLOORS[k])).alias(f"w{i}") for i, k in enumerate(NAMES))), "scales")
    z = _joined(rows, scales, ["g"], n).select("g", *(((F.col(k) - F.col(f"m{i}")) / F.col(f"w{i}")).alias(f"z{i}") for i, k in enumerate(NAMES)))
    z = z.withColumn("norm", F.greatest(F.sqrt(sum((F.col(f"z{i}") ** 2 for i in p[1:]), F.col("z0") ** 2)), F.lit(1e-9)))
    whole = lambda x: F.round(x * UNIT) / UNIT
    z = z.select("g", *(whole(F.tanh(f"z{i}")).alias(f"t{i}") for i in p), *(whole(F.col(f"z{i}") / F.col("norm")).alias(f"u{i}") for i in p))
    sums = z.groupBy("g").agg(*(F.sum(F.col(f"{k}{i}") * F.col(f"{k}{j}")).alias(f"{k}{i}{j}") for k in "tu" for i in p for j in range(i + 1)))
    both = scales.join(sums, "g").select("*", F.explode(F.array(*map(F.lit, range(3)))).alias("s"))

    def covariance(i: int, j: int) -> Column:
        if i == j:
            return F.col(f"w{i}") ** 2
        r = [F.col(f"{k}{i}{j}") / F.greatest(F.sqrt(F.col(f"{k}{i}{i}") * F.col(f"{k}{j}{j}")), F.lit(1e-9)) for k in "tu"]
        return F.when(F.col("s") == 1, r[0]).when(F.col("s") == 2, r[1]).otherwise(0.0) * F.col(f"w{i}") * F.col(f"w{j}")

    return _factor(both, covariance).select(*_model_columns())


def _solved() -> list[Column]:
    """The statistics less m0.., divided by the factor l00.. by forward substitution: y0.. in turn."""
    y: list[Column] = []
    for i, k in enumerate(NAMES):
        rest = F.col(k) - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * F.col(f"y{j}")
        y.append(rest / F.col(f"l{i}{i}"))
    return y


def with_distance(rows: DataFrame) -> DataFrame:
    """rows with d2, the squared Mahalanobis distance from their group's centre."""
    for i, y in enumerate(_solved()):
        rows = rows.withColumn(f"y{i}", y)
    total = sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(1, len(NAMES))), F.col("y0") * F.col("y0"))
    return rows.withColumn("d2", total).drop(*(f"y{i}" for i in range(len(NAMES))))


def _step(rows: DataFrame, model: DataFrame, n: int) -> DataFrame:
    """The estimates from the nearest texts of each group by the ones before; as many rows as model has."""
    p = range(len(NAMES))
    at = with_distance(_joined(rows, model, ["g"], 3 * n)).withColumn("b", F.least(F.floor(BINS_PER_OCTAVE * F.log2(1 + F.col("d2"))), F.lit(MOST_BIN)))
    sums = [F.count("*").alias("n"), *(F.sum(NAMES[i]).alias(f"s{i}") for i in p), *(F.sum(F.col(NAMES[i]) * F.col(NAMES[j])).alias(f"s{i}{j}") for i in p for j in range(i + 1))]
    bins = at.groupBy("g", "s", "b").agg(*sums)
    by = W.partitionBy("g", "s")
    bins = bins.withColumn("before", F.sum("n").over(by.orderBy("b")) - F.col("n")).withColumn("all", F.sum("n").over(by))
    near = bins.where(F.col("before") < F.ceil(SUPPORT * F.col("all"))).groupBy("g", "s").agg(F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in bins.columns if c.startswith("s") and c != "s"))
    out = near.select("g", "s", *((F.col(f"s{i}") / F.col("n")).alias(f"m{i}") for i in p), *((F.col(f"s{i}{j}") / F.col("n")).alias(f"q{i}{j}") for i in p for j in range(i + 1)))

    def covariance(i: int, j: int) -> Column:
        c = F.lit(CONSISTENCY) * (F.col(f"q{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}"))
        return F.greatest(c, F.lit(0.0)) + F.lit(FLOORS[NAMES[i]] ** 2) if i == j else c

    return _factor(out, covariance).select(*_model_columns())


def estimates(rows: DataFrame, n: int) -> DataFrame:
    """By g, of which there are n at most, the estimate m0.. and l00.. of the least determinant (logdet) that the starts (s) lead to."""
    # a start's own determinant isn't one of a subset, so the first step counts as a fall
    model = written(_step(rows, written(_starts(rows, n), "starts"), n).withColumn("fell", F.lit(True)), "step")
    while not model.where("fell").isEmpty():
        new = _step(rows, model.where("fell").drop("fell"), n).select("g", "s", *(F.col(c).alias(f"_{c}") for c in _model_columns()[2:]))
        fell = F.col("fell") & (F.col("_logdet") < F.col("logdet") - LEAST_FALL)
        model = written(model.join(new, ["g", "s"], "left").select("g", "s", *(F.when(fell, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in _model_columns()[2:]), F.coalesce(fell, F.lit(False)).alias("fell")), "step")
    best = model.groupBy("g").agg(F.min_by(F.struct(*_model_columns()[1:]), F.struct("logdet", "s")).alias("best"))
    return best.select("g", "best.*")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", by: tuple[str, str] = ("lang", "source"), cutoff: float = CUTOFF) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, distance, kept of each row."""
    out = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    stats = written(base(docs, id_col, text_col, by), "stats")
    groups = written(_groups(stats.where("not base_failed")), "groups")
    n = groups.count()
    rows = written(_joined(vectors(stats.where("not base_failed")), groups, ["g1", "g2"], n).select("g", *NAMES, *out), "vectors")
    judged = with_distance(_joined(rows, written(estimates(rows, n), "estimates"), ["g"], n))
    passed = judged.select(*out, F.col("d2").alias("distance"), (F.col("d2") <= cutoff).alias("kept"))
    return passed.unionByName(stats.where("base_failed").select(*out, F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept")))
