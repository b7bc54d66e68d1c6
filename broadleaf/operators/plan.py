"""Validation of a proposed front page: the first broken rule is the verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadleaf import fixed as V
from broadleaf.functions import text as X

BRIEF = "struct<schema_version:string,mode:string,source_candidate_ids:array<string>,editorial_idea:string,central_subject:string,visual_metaphor:string,visual_relationship:string,composition:string,literal_elements:array<string>,abstraction_level:string,forbidden_elements:array<string>,failure_modes:array<string>,alt_text:string>"
PLAN = f"struct<lead_candidate_id:string,front_page:array<struct<candidate_id:string,role:string>>,section_order:array<string>,visual_brief:{BRIEF}>"
ROLES, MODES, LEVELS = ("lead", "secondary", "brief"), ("lead_story", "edition_theme", "none"), ("low", "medium", "high")


def bad_text(value: Column, most: int = 500, empty: Column | bool = False) -> Column:
    """V3: null, blank (unless allowed), too long, with control characters, addresses, tags or Markdown links."""
    blank = (X.stripped(value) == "") & ~(F.lit(empty) if isinstance(empty, bool) else empty)
    return value.isNull() | blank | (F.char_length(value) > most) | value.rlike(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]") | value.rlike(r"(?i)https?://|<[^>]+>|\[[^\]]+\]\([^)]+\)")


def _text(value: Column) -> Column:
    """The string of a variant; null if it is of another type."""
    return F.when(F.to_json(value).startswith('"'), F.try_variant_get(value, "$", "string"))


def _list(value: Column) -> Column:
    """The elements of a variant, as variants; null if it is no array."""
    return F.try_variant_get(value, "$", "array<variant>")


def _texts(value: Column) -> Column:
    """The elements of a list of variants as strings, those of other types null."""
    return F.transform(value, _text)


def _has_keys(value: Column, *keys: tuple[str, ...]) -> Column:
    """Whether a variant is an object of just these keys, in one of the sets given."""
    found = F.array_sort(F.json_object_keys(F.to_json(value)))
    out = F.lit(False)
    for names in keys:
        out = out | (found == F.array(*map(F.lit, sorted(names))))
    return F.coalesce(out, F.lit(False))


def _repeats(values: Column) -> Column:
    return F.size(F.array_distinct(values)) != F.size(values)


def strict(content: Column) -> Column:
    """JSON text with NaN and the infinities, where they are values, as 0: as much a number, and what a strict parser takes."""
    text = r'"(?:[^"\\]|\\.)*+"'
    number = F.regexp_replace(content, rf"(?s)\G((?:[^\"NI-]|{text}|-(?!Infinity|NaN))*+)(?:NaN|-?Infinity)", "$10")
    return F.when(content.contains("NaN") | content.contains("Infinity"), number).otherwise(content)


def parse_error(content: Column) -> Column:
    """V4: null for a JSON object. NaN and infinities are numbers, and of repeated keys the last counts (see validate)."""
    listed = F.try_parse_json(F.concat(F.lit("["), strict(content), F.lit("]")))  # the parser overlooks what follows a value
    bad = listed.isNull() | F.try_variant_get(listed, "$[1]", "variant").isNotNull() | F.try_variant_get(listed, "$[0]", "variant").isNull()
    return F.when(content.isNull(), "plan_content_missing").when(bad, "plan_malformed_json").when(~F.ltrim(content, F.lit(" \t\r\n")).startswith("{"), "plan_not_object")


def validate(plans: DataFrame, candidates: DataFrame, by: str = "date", content_col: str = "content") -> DataFrame:
    """Plans with `error`, the first broken rule of the first broken part, or null, and `plan`, the plan with its texts stripped, or null.

    candidates: by, candidate_id, sector_slug, eligible. Sets the session to take JSON with repeated keys.
    """
    plans.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    known = candidates.groupBy(by).agg(
        F.collect_set("candidate_id").alias("_ids"),
        F.collect_set(F.when(F.col("eligible"), F.col("candidate_id"))).alias("_good"),
        F.collect_set("sector_slug").alias("_sectors"),
        F.count_if("eligible").alias("_n"),
    )
    none = F.array().cast("array<string>")
    # rows are small beside the work on each: dealt out evenly, whatever files they came from and however few bytes adaptive execution finds in the join
    dealt = plans.join(known, by, "left").repartition(int(plans.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = dealt.withColumns({"_malformed": parse_error(F.col(content_col)), "_v": F.try_parse_json(strict(F.col(content_col)))})
    rows = rows.withColumns({c: F.coalesce(c, none) for c in ("_ids", "_good", "_sectors")})
    part = lambda v, name: F.try_variant_get(v, f"$.{name}", "variant")
    rows = rows.withColumns({"_front": _list(part(F.col("_v"), "front_page")), "_order": _list(part(F.col("_v"), "section_order")), "_brief": part(F.col("_v"), "visual_brief"), "_lead": _text(part(F.col("_v"), "lead_candidate_id"))})
    brief = F.col("_brief")
    texts, lists = [*V.TEXT_LIMITS, "mode", "schema_version", "abstraction_level"], [*V.LIST_LIMITS, "source_candidate_ids"]
    rows = rows.withColumns({f"_b_{k}": _text(part(brief, k)) for k in texts} | {f"_b_{k}": _list(part(brief, k)) for k in lists})
    entry = lambda x: F.struct(
        _has_keys(x, ("candidate_id", "role")).alias("whole"), _text(part(x, "candidate_id")).alias("raw"), X.stripped(_text(part(x, "candidate_id"))).alias("candidate_id"), _text(part(x, "role")).alias("role")
    )
    rows = rows.withColumns({"_entries": F.transform("_front", entry), "_sections": _texts(F.col("_order")), "_sources": _texts(F.col("_b_source_candidate_ids")), "_first": _has_keys(brief, V.BRIEF_1_KEYS), "_second": _has_keys(brief, V.BRIEF_2_KEYS)})
    broken_entry = lambda e: (
        F.when(~e["whole"], "plan_entry_properties")
        .when(bad_text(e["raw"], 16), "plan_invalid_candidate_id")
        .when(~F.coalesce(e["role"].isin(*ROLES), F.lit(False)), "plan_role")
        .when(~F.array_contains("_ids", e["candidate_id"]), "plan_unknown_candidate")
        .when(~F.array_contains("_good", e["candidate_id"]), "plan_ineligible_candidate")
    )
    rows = rows.withColumn("_entry", F.get(F.filter(F.transform("_entries", broken_entry), lambda c: c.isNotNull()), F.lit(0)))
    entries, lead, mode, src, second = F.col("_entries"), X.stripped(F.col("_lead")), F.col("_b_mode"), F.col("_sources"), F.col("_second")
    ids = F.transform(entries, lambda e: e["candidate_id"])
    count = lambda role: F.size(F.filter(entries, lambda e: e["role"] == role))
    free = mode == "none"
    strange = lambda values: F.exists(values, lambda x: x.isNull())
    rules = [
        (F.col("_malformed").isNotNull(), F.col("_malformed")),
        (~_has_keys(F.col("_v"), V.PLAN_KEYS), "plan_unknown_properties"),
        (bad_text(F.col("_lead"), 16), "plan_invalid_lead_id"),
        (F.col("_front").isNull() | (F.size("_front") != F.least(F.lit(V.FRONT_PAGE_SIZE), F.coalesce("_n", F.lit(0)))), "plan_front_page_count"),
        (F.col("_entry").isNotNull(), F.col("_entry")),
        (_repeats(ids), "plan_duplicate_candidate"),
        ((count("lead") != 1) | ~F.exists(entries, lambda e: (e["role"] == "lead") & (e["candidate_id"] == lead)), "plan_lead"),
        (count("secondary") > V.SECONDARY_SIZE, "plan_secondary_count"),
        (F.col("_order").isNull() | strange(F.col("_sections")) | _repeats(F.col("_sections")) | (F.size(F.array_except("_sections", "_sectors")) > 0), "plan_section_order"),
        (~(F.col("_first") | second), "plan_visual_properties"),
        (~F.coalesce(mode.isin(*MODES), F.lit(False)), "plan_visual_mode"),
        (src.isNull() | strange(src) | (F.size(src) > 3) | _repeats(src) | (F.size(F.array_except(src, ids)) > 0), "plan_visual_sources"),
        (free & (F.size(src) > 0), "plan_visual_none_sources"),
        (~free & (F.size(src) == 0), "plan_visual_sources"),
        ((mode == "lead_story") & (src != F.array(lead)), "plan_lead_visual_source"),
        (second & ~F.col("_b_schema_version").eqNullSafe(F.lit(V.BRIEF_2_VERSION)), "plan_visual_schema_version"),
    ]
    for k, most in V.TEXT_LIMITS.items():
        has = second if k not in V.BRIEF_1_KEYS else ~second if k not in V.BRIEF_2_KEYS else F.lit(True)
        rules.append((has & bad_text(F.col(f"_b_{k}"), most, free), f"plan_invalid_{k}"))
    rules.append((second & ~F.coalesce(F.col("_b_abstraction_level").isin(*LEVELS), F.lit(False)), "plan_abstraction_level"))
    cleaned = {k: F.transform(_texts(F.col(f"_b_{k}")), X.stripped) for k in V.LIST_LIMITS}
    for k, most in V.LIST_LIMITS.items():
        has = second if k not in V.BRIEF_1_KEYS else F.lit(True)
        given = F.col(f"_b_{k}")
        rules += [
            (has & (given.isNull() | (F.size(given) > most)), f"plan_{k}"),
            (has & F.exists(_texts(given), lambda x: bad_text(x, 100)), f"plan_invalid_{k[:-1]}"),
            (second & _repeats(cleaned[k]), f"plan_{k}"),
        ]
    rules.append((F.col("_b_alt_text").rlike(r"(?i)\b(photo|photograph|photographic)\b"), "plan_alt_text_photo"))
    error = F.lit(None).cast("string")
    for broken, code in reversed(rules):
        error = F.when(F.coalesce(broken, F.lit(False)), F.lit(code) if isinstance(code, str) else code).otherwise(error)
    rows = rows.withColumn("error", error)
    own = {k: X.stripped(F.col(f"_b_{k}")) for k in V.TEXT_LIMITS} | cleaned | {k: F.col(f"_b_{k}") for k in ("mode", "schema_version", "abstraction_level")} | {"source_candidate_ids": src}
    names = [f.split(":")[0] for f in BRIEF[7:-1].split(",")]
    pairs = F.transform(entries, lambda e: F.struct(e["candidate_id"].alias("candidate_id"), e["role"].alias("role")))
    clean = F.struct(lead.alias("lead_candidate_id"), pairs.alias("front_page"), F.col("_sections").alias("section_order"), F.struct(*(own[k].alias(k) for k in names)).alias("visual_brief"))
    return rows.withColumn("plan", F.when(F.col("error").isNull(), clean)).select(*plans.columns, "error", "plan")
