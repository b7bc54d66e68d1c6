"""From issue documents to a day's candidates, shortlist and front page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from broadleaf import fixed as V
from broadleaf.functions import text as X
from broadleaf.functions import urls as U
from broadleaf.sources.corpus import compact_json

DOSSIER = ("candidate_id", "content_class", "reading_time", "section_heading", "sector_slug", "source_domain", "summary", "title")


def content_class(content_type: Column, is_sponsor: Column) -> Column:
    """P5, U5."""
    kind = F.lower(content_type)
    return F.when(F.coalesce(is_sponsor, F.lit(False)) | (kind == "sponsor"), "sponsor").when(kind.isin(*V.RESOURCE_TYPES), "resource").otherwise("editorial")


def class_rank(name: Column) -> Column:
    out = F.lit(None).cast("int")
    for k, v in V.CLASS_RANK.items():
        out = F.when(name == k, F.lit(v)).otherwise(out)
    return out


def front_page_eligible(klass: Column, title: Column, summary: Column) -> Column:
    """P6."""
    return (klass == "editorial") & (X.stripped(title) != "") & (X.stripped(summary) != "")


def latest_date(manifest: DataFrame) -> DataFrame:
    """A3: the latest date that didn't fail; an error if there is none."""
    found = manifest.where("parse_status is null or parse_status <> 'failed'").agg(F.max("date").alias("date"))
    return found.select(F.coalesce("date", F.raise_error(F.lit("no_complete_issue_dates")).cast("string")).alias("date"))


def articles(issues: DataFrame) -> DataFrame:
    """One row per article with zero-based places si and ai."""
    s = issues.select("issue_id", "sector_slug", "date", F.posexplode("sections").alias("si", "s"))
    return s.select("issue_id", "sector_slug", "date", "si", F.col("s.heading").alias("section_heading"), F.posexplode("s.articles").alias("ai", "a")).select("issue_id", "sector_slug", "date", "si", "ai", "section_heading", "a.*")


def candidates(rows: DataFrame) -> DataFrame:
    """P3, P5, P9, P10, W1, W2, L3 on article rows: valid ones, one per article (highest class, then first), one per class and canonical URL."""
    url = U.canonical(F.col("url"))
    rows = rows.where((X.stripped(F.col("title")) != "") & (F.coalesce("id", F.lit("")) != "")).withColumn("canonical_url", url).where("canonical_url is not null")
    rows = rows.select(
        "date", "issue_id", F.col("id").alias("article_id"), F.coalesce("sector_slug", F.lit("unknown")).alias("sector_slug"), F.coalesce("section_heading", F.lit("")).alias("section_heading"),
        X.stripped(F.col("title")).alias("title"), X.stripped(F.coalesce("summary", F.lit(""))).alias("summary"), "canonical_url",
        F.lower(F.coalesce(F.nullif("source_domain", F.lit("")), U.hostname(U.netloc(F.col("canonical_url"))))).alias("source_domain"),
        F.col("reading_time_minutes").cast("int").alias("reading_time"), content_class(F.col("content_type"), F.col("is_sponsor")).alias("content_class"), "si", "ai",
    )
    best = F.row_number().over(W.partitionBy("issue_id", "article_id").orderBy(class_rank(F.col("content_class")).desc(), "si", "ai"))
    rows = rows.withColumn("n", best).where("n = 1")
    first = F.row_number().over(W.partitionBy("date", "content_class", "canonical_url").orderBy(X.sector_rank(F.col("sector_slug")), X.sector_name(F.col("sector_slug")), "si", "ai", "issue_id", "article_id"))
    return rows.withColumn("n", first).where("n = 1").drop("n")


def load_date(manifest: DataFrame, issues: DataFrame, date: str) -> DataFrame:
    """Candidates of a date, through verified documents; the date prunes the manifest before the join."""
    from broadleaf.sources.corpus import verified_issues

    today = manifest.where((F.col("date") == date) & (F.coalesce("parse_status", F.lit("")) != "failed"))
    return candidates(articles(verified_issues(today, issues)))


def shortlist(found: DataFrame, cap: int = V.SHORTLIST_CAP, by: tuple[str, ...] = ("date",)) -> DataFrame:
    """The n-th of every sector in turn, up to cap a date, with candidate ids."""
    order = ("si", "ai", "issue_id", "article_id")
    rows = found.withColumn("nth", F.row_number().over(W.partitionBy(*by, "sector_slug").orderBy(*order))).where(F.col("nth") <= cap)
    rank = F.row_number().over(W.partitionBy(*by).orderBy("nth", X.sector_rank(F.col("sector_slug")), X.sector_name(F.col("sector_slug"))))
    return rows.withColumn("n", rank).where(F.col("n") <= cap).withColumn("candidate_id", X.candidate_id(F.col("n"))).drop("nth")


def dossier(found: DataFrame) -> DataFrame:
    """What a planner sees of each candidate, without addresses."""
    return found.select(*DOSSIER)


def dossier_bytes(found: DataFrame, by: tuple[str, ...] = ("date",)) -> DataFrame:
    """Size of the canonical JSON list, by date."""
    entry = F.struct("n", F.struct(*DOSSIER).alias("e"))
    listed = F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["e"])
    return found.groupBy(*by).agg(F.octet_length(compact_json(listed)).cast("long").alias("dossier_bytes"))


def fallback(eligible: DataFrame, by: str, sector: str, pos: str) -> DataFrame:
    """By date the lead (of the lead sector, or the first), up to four secondaries (new sectors first), briefs up to nine in all."""
    lead = F.row_number().over(W.partitionBy(by).orderBy(F.when(F.col(sector) == V.LEAD_SECTOR, 0).otherwise(1), pos)) == 1
    rows = eligible.withColumn("is_lead", lead).withColumn("lead_sector", F.max(F.when(F.col("is_lead"), F.col(sector))).over(W.partitionBy(by)))
    rows = rows.withColumn("rs", F.row_number().over(W.partitionBy(by, sector, "is_lead").orderBy(pos)))
    new = F.when((F.col(sector) != F.col("lead_sector")) & (F.col("rs") == 1), 0).otherwise(1)
    rows = rows.withColumn("kr", F.when(F.col("is_lead"), 0).otherwise(F.row_number().over(W.partitionBy(by, "is_lead").orderBy(new, pos))))
    rows = rows.withColumn("role", F.when(F.col("is_lead"), "lead").when(F.col("kr") <= V.SECONDARY_SIZE, "secondary").otherwise("brief"))
    place = F.when(F.col("role") == "lead", 0).when(F.col("role") == "secondary", 1).otherwise(2)
    rk = F.row_number().over(W.partitionBy(by).orderBy(place, F.when(F.col("role") == "secondary", F.col("kr")).otherwise(F.col(pos))))
    return rows.withColumn("rk", rk).where(F.col("rk") <= V.FRONT_PAGE_SIZE).drop("is_lead", "lead_sector", "rs", "kr")


def section_order(page: DataFrame, by: str, sector: str) -> DataFrame:
    """Sectors of a front page in order of first sight."""
    first = page.groupBy(by, sector).agg(F.min("rk").alias("rk"))
    return first.groupBy(by).agg(F.transform(F.array_sort(F.collect_list(F.struct("rk", sector))), lambda x: x[sector]).alias("section_order"))


def resolve_plan(plans: DataFrame, found: DataFrame, by: str = "date") -> DataFrame:
    """Plans (by, front_page) with (issue_id, article_id, role) in place of candidate ids, order kept."""
    picks = plans.select(by, F.posexplode("front_page").alias("pos", "x")).select(by, "pos", F.col("x.candidate_id").alias("candidate_id"), F.col("x.role").alias("role"))
    rows = picks.join(found.select(by, "candidate_id", "issue_id", "article_id"), [by, "candidate_id"])
    return rows.groupBy(by).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "issue_id", "article_id", "role"))), lambda x: F.struct(x["issue_id"].alias("issue_id"), x["article_id"].alias("article_id"), x["role"].alias("role"))).alias("front_page"))


def story_errors(stories: DataFrame, manifest: DataFrame, found: DataFrame) -> DataFrame:
    """story_id and the first reason why a registered story can't be used; null if it can."""
    entries = manifest.groupBy("date", "issue_id").agg(F.count("*").alias("n_entries"), F.max("parse_status").alias("status"))
    refs = found.groupBy("date", "issue_id", "article_id").agg(F.count("*").alias("n"), *(F.max(c).alias(f"c_{c}") for c in ("content_class", "title", "summary")))
    rows = stories.join(entries, ["date", "issue_id"], "left").join(refs, ["date", "issue_id", "article_id"], "left")
    error = (
        F.when((F.coalesce("n_entries", F.lit(0)) != 1) | (F.coalesce("status", F.lit("")) != "complete"), "calibration_story_issue_incomplete")
        .when(F.coalesce("n", F.lit(0)) != 1, "calibration_story_reference_invalid")
        .when(F.col("c_content_class") != "editorial", "calibration_story_not_editorial")
        .when(F.col("c_title") != F.col("expected_title"), "calibration_story_title_drift")
        .when(X.content_hash(F.col("c_summary")) != F.col("expected_summary_sha256"), "calibration_story_summary_drift")
    )
    return rows.select("story_id", error.alias("error"))


def bounded_product(left: DataFrame, right: DataFrame, most: int) -> DataFrame:
    """All combinations of two small registries; an error beyond `most` of them."""
    n = left.count() * right.count()
    if n > most:
        raise ValueError(f"{n} combinations; at most {most} are allowed")
    return left.crossJoin(F.broadcast(right))


def chosen_pairs(product: DataFrame, pairs: DataFrame) -> DataFrame:
    """Combinations named in pairs (style, concept)."""
    return product.join(pairs, ["style", "concept"], "left_semi")


def illustration_hash_1(brief: Column, sources: Column, model: Column, version: Column, config: Column) -> Column:
    """F18, first contract: hash of a brief (struct), the sources' titles and summaries, model, version and image settings."""
    facts = F.transform(sources, lambda s: F.struct(s["summary"].alias("summary"), s["title"].alias("title")))
    return X.hash_parts(*map(X.canonical_json, (brief, facts, model, version, config)))


#: Fields of an illustration profile that its hash takes, in order.
PROFILE = ("fixed_negative_constraints", "internal_id", "preamble", "profile_id", "rendering_material_constraints", "schema_version", "shared_factual_restrictions")


def illustration_hash_2(profile: Column, brief: Column, sources: Column, model: Column, config: Column, version: str = V.ILLUSTRATION_PROMPT_VERSION) -> Column:
    """F18, second contract: hash of the profile's contract, the brief, the exact facts of its sources, model and image settings."""
    facts = F.transform(sources, lambda s: F.struct(*(s[k].alias(k) for k in ("article_id", "issue_id", "summary", "title"))))
    contract = F.struct(
        facts.alias("exact_sources"),
        F.struct(*(profile[k].alias(k) for k in PROFILE)).alias("illustration_profile"),
        F.lit(version).alias("illustration_prompt_version"),
        config.alias("image_configuration"),
        model.alias("image_model"),
        brief.alias("visual_brief"),
        brief["schema_version"].alias("visual_brief_schema_version"),
    )
    return X.hash_parts(X.canonical_json(contract))


def _blocks(pairs: list[tuple[str, Column]]) -> Column:
    """Titled blocks of lines, a blank line before each; a block is a string or an array of lines."""
    return F.flatten(F.array(*(F.concat(F.array(F.lit(""), F.lit(title)), lines) for title, lines in pairs)))


def prompt_2(preamble: Column, stories: Column, brief: Column, restrictions: list[str]) -> Column:
    """F19, second form: a titled block for each part of a brief; restrictions are the profile's own sentences."""
    facts = F.flatten(F.transform(stories, lambda s: F.array(F.concat(F.lit("Title: "), s["title"]), F.concat(F.lit("Summary: "), s["summary"]))))
    one = lambda name: F.array(brief[name])
    head = F.concat(F.array(F.lit("Rendering style:"), preamble, F.lit(""), F.lit("Exact source facts:")), facts)
    rest = _blocks([
        ("Editorial idea:", one("editorial_idea")), ("Central subject:", one("central_subject")), ("Visual relationship:", one("visual_relationship")), ("Composition:", one("composition")),
        ("Permitted literal elements:", brief["literal_elements"]), ("Abstraction level:", one("abstraction_level")), ("Story-specific forbidden elements:", brief["forbidden_elements"]),
        ("Likely failure modes to avoid:", brief["failure_modes"]), ("Global factual restrictions:", F.array(*map(F.lit, restrictions))),
    ])
    return F.concat(X.stripped(F.array_join(F.concat(head, rest), "\n")), F.lit("\n"))


def prompt(preamble: Column, stories: Column, subject: Column, metaphor: Column, composition: Column, forbidden: Column) -> Column:
    """a prompt's lines from a brief and its source stories (title, summary)."""
    facts = F.flatten(F.transform(stories, lambda s: F.array(F.concat(F.lit("Title: "), s["title"]), F.concat(F.lit("Summary: "), s["summary"]))))
    ban = F.when(F.size(forbidden) == 0, "none beyond the fixed restrictions").otherwise(F.array_join(forbidden, ", "))
    head = F.array(preamble, F.lit(""), F.lit("Source stories (use only these facts):"))
    tail = F.array(F.lit(""), F.concat(F.lit("Central subject: "), subject), F.concat(F.lit("Visual metaphor: "), metaphor), F.concat(F.lit("Composition: "), composition), F.concat(F.lit("Forbidden elements: "), ban))
    return F.concat(X.stripped(F.array_join(F.concat(head, facts, tail), "\n")), F.lit("\n"))


def stale(artifacts: DataFrame, inputs: DataFrame, key: str = "date") -> DataFrame:
    """Artifacts whose stored input_hash differs from the recomputed one, or has none."""
    now = inputs.select(key, F.col("input_hash").alias("now"))
    return artifacts.join(now, key, "left").where(~F.col("input_hash").eqNullSafe(F.col("now"))).select(*artifacts.columns)


def mismatches(artifacts: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Artifacts with the list of `<field>_mismatch` reasons, in order."""
    reasons = F.filter(F.array(*(F.when(~F.col(k).eqNullSafe(F.lit(v)), f"{k}_mismatch") for k, v in wanted.items())), lambda x: x.isNotNull())
    return artifacts.withColumn("reasons", reasons)


def rubric_score(scores: list[Column]) -> Column:
    """Weighted mean of rubric scores."""
    total = sum((s * w for s, w in zip(scores, V.RUBRIC_WEIGHTS, strict=True)), F.lit(0))
    return total / sum(V.RUBRIC_WEIGHTS)
