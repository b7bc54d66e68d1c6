"""Queries over inventories, artifacts and JSON of any shape."""

from __future__ import annotations

from pyspark.sql import functions as F

from broadleaf.functions import text as X
from broadleaf.operators import derive, inventory, validate
from broadleaf.plans.catalogue import _ISSUES, newsletters, query, scratch, table
from broadleaf.sources import corpus

_OLD, _NEW = "doc_id % 83 <> 0", "doc_id % 89 <> 0"
_PATH = "source || '/' || coalesce(lang, 'none') || '/' || doc_id || '.md'"


@query(f"""WITH f AS (SELECT coalesce({_PATH}, 'none/' || doc_id) AS path, sha256(coalesce(text, '')) AS h, {_OLD} AS was, {_NEW} AS is_now, doc_id % 97 = 0 AS edited FROM documents)
SELECT path, CASE WHEN NOT was THEN 'added' WHEN NOT is_now THEN 'removed' ELSE 'changed' END AS change FROM f WHERE was <> is_now OR was AND is_now AND edited""")
def q_inventory_diff(spark, sf_dir):
    """Two inventories of documents as trees; the difference found from the root down."""
    d, i = table(spark, sf_dir, "documents"), F.col("doc_id").cast("string")
    path = F.coalesce(F.concat("source", F.lit("/"), F.coalesce("lang", F.lit("none")), F.lit("/"), i, F.lit(".md")), F.concat(F.lit("none/"), i))
    sha = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    root = scratch(spark, "inventory")
    inventory.write_tree(d.where(_OLD).select(path.alias("path"), sha.alias("hash")), f"{root}/old")
    inventory.write_tree(d.where(_NEW).select(path.alias("path"), F.when(F.col("doc_id") % 97 == 0, F.reverse(sha)).otherwise(sha).alias("hash")), f"{root}/new")
    return inventory.diff(spark, f"{root}/old", f"{root}/new", root)[0]


_STALE_BRIEF, _STALE_PROMPT, _STALE_IMAGE = "o_orderkey % 11 = 0", "o_orderkey % 13 = 0", "(l_orderkey + l_linenumber) % 17 = 0"


@query(f"""WITH p AS (SELECT o_orderkey AS k, o_orderkey % 11 = 0 AS b, o_orderkey % 13 = 0 AS m FROM orders),
l AS (SELECT l_orderkey AS k, l_linenumber AS n, {_STALE_IMAGE} AS i FROM lineitem),
x AS (SELECT 'prompt ' || k AS id, CASE WHEN b THEN 0 END AS steps FROM p
UNION ALL SELECT 'image ' || l.k || ' ' || n, CASE WHEN m THEN 0 WHEN b THEN 1 END FROM l JOIN p ON l.k = p.k
UNION ALL SELECT 'object ' || l.k || ' ' || n, CASE WHEN i THEN 0 WHEN m THEN 1 WHEN b THEN 2 END FROM l JOIN p ON l.k = p.k)
SELECT DISTINCT id, steps FROM x WHERE steps IS NOT NULL""")
def q_stale_chain(spark, sf_dir):
    """Briefs, prompts, images and objects of orders and their lines; what hangs on a changed one is stale."""
    o, l = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    key = F.col("o_orderkey").cast("string")
    line = F.concat_ws(" ", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    name = lambda kind, k: F.concat(F.lit(kind + " "), k)
    made = o.select(name("brief", key).alias("id")).unionByName(o.select(name("prompt", key).alias("id"))).unionByName(l.select(name("image", line).alias("id"))).unionByName(l.select(name("object", line).alias("id")))
    made = made.withColumn("hash", F.sha2(F.col("id").cast("binary"), 256))
    then = lambda of, changed: F.when(F.expr(changed), "before").otherwise(F.sha2(of.cast("binary"), 256))
    prompts = o.select(name("prompt", key).alias("id"), name("brief", key).alias("input_id"), then(name("brief", key), _STALE_BRIEF).alias("input_hash"))
    parent = name("prompt", F.col("l_orderkey").cast("string"))
    images = l.select(name("image", line).alias("id"), parent.alias("input_id"), then(parent, _STALE_PROMPT.replace("o_orderkey", "l_orderkey")).alias("input_hash"))
    objects = l.select(name("object", line).alias("id"), name("image", line).alias("input_id"), then(name("image", line), _STALE_IMAGE).alias("input_hash"))
    return inventory.stale(made, prompts.unionByName(images).unionByName(objects))


_ITEM = "'{\"a\":[1,{\"x\":null,\"y\":' || CAST(to_json(kind) AS VARCHAR) || '}],\"client\":' || coalesce(client_id::VARCHAR, 'null') || ',\"props\":{\"device\":{\"os\":' || CAST(props->'$.device.os' AS VARCHAR) || ',\"ver\":' || CAST(props->'$.device.ver' AS VARCHAR) || '},\"k\":' || CAST(props->'$.k' AS VARCHAR) || ',\"tags\":' || CAST(props->'$.tags' AS VARCHAR) || '}}'"


@query(f"SELECT click_id, ts, {_ITEM} AS json FROM clicks WHERE kind IS NOT NULL AND json_valid(props) AND list_sort(json_keys(props)) = ['device', 'k', 'tags'] AND list_sort(json_keys(props, '$.device')) = ['os', 'ver']")
def q_canonical_json(spark, sf_dir):
    """S20 for JSON of any shape: keys sorted at every depth."""
    rows = table(spark, sf_dir, "clicks").where("kind IS NOT NULL")
    given = F.concat(F.lit('{"props": '), "props", F.lit(', "client": '), F.coalesce(F.col("client_id").cast("string"), F.lit("null")), F.lit(', "a": [1, {"y": '), F.to_json(F.struct("kind")).substr(F.lit(9), F.char_length(F.to_json(F.struct("kind"))) - 9), F.lit(', "x": null}]}'))
    keys = lambda of: F.array_sort(F.json_object_keys(of))
    whole = (keys(F.col("props")) == F.array(*map(F.lit, ("device", "k", "tags")))) & (keys(F.get_json_object("props", "$.device")) == F.array(F.lit("os"), F.lit("ver")))
    return rows.where(F.try_parse_json("props").isNotNull() & whole).select("click_id", "ts", X.sorted_json(given).alias("json"))


@query(f"""WITH {_ISSUES}, z AS (SELECT CASE WHEN n IS NULL THEN 'failed' WHEN codes IS NOT NULL OR open > 0 THEN 'partial' ELSE 'complete' END AS status, coalesce(n, 0) AS n, codes FROM i LEFT JOIN k ON i.conv_id = k.conv_id)
SELECT count(*) AS sources, count(*) FILTER (status = 'complete') AS complete, count(*) FILTER (status = 'partial') AS partial, count(*) FILTER (status = 'failed') AS failed, sum(n)::BIGINT AS articles FROM z""")
def q_observed_report(spark, sf_dir):
    """A1, A2: counts taken while the documents are written, in the same job."""
    issues = derive.issues(corpus.named_sources(newsletters(spark, sf_dir)))
    return validate.written_with_report(issues, f"{scratch(spark, 'observed')}/issues")
