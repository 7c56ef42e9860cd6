"""The registered queries of the llm operators and, where SQL can say the same, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.functions.rounding import half_away
from furrow.llm.clusters import Features, Tree, fit_tree, linked_patches, similarity_clusters, typical_members
from furrow.llm.digests import build_digests, certified_quantiles, certify, merge_digests, quantiles, rank_bound
from furrow.llm.lookalikes import look_alike_classes, look_alike_pairs, tables
from furrow.llm.mixing import Mix, mix
from furrow.llm.packing import pack
from furrow.llm.topn import top_n
from furrow.plans.crops import COUNTING_SQL, POSITION_SQL, counting_rows, stage_name, table, usable, usable_position
from furrow.session import stage

# Fixed values of the problems' statements.
LINK_METRES = 0.80
PATCH_LEAST = 4
TOP = 5
DIGEST = 400.0
#: Between sectors, in metres of the feature space.
SECTOR_WEIGHT = 25.0


#: Squares in metres by which rows are pre-aggregated for k-means.
RESOLUTION = 8.0


def _plants(spark: SparkSession, d: str) -> tuple[DataFrame, Tree]:
    rows = counting_rows(table(spark, d, "pineapple_crops"), "sector_id", "geo_x", "geo_y").where(usable_position() & usable("sector_id"))
    rows = stage(rows, "plants")
    return rows, fit_tree(rows, Features({"geo_x": 1.0, "geo_y": 1.0}, {"sector_id": SECTOR_WEIGHT}), {"geo_x": RESOLUTION, "geo_y": RESOLUTION})


def _patches(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows, tree = _plants(spark, d)
    return rows, linked_patches(rows, "plant_id", "geo_x", "geo_y", "sector_id", LINK_METRES, PATCH_LEAST, tree)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _patches(spark, d)[1].where("id <> patch").select(F.col("patch").alias("plant_id_a"), F.col("id").alias("plant_id_b"))


def p1_patches(spark: SparkSession, d: str) -> DataFrame:
    """Each patch with its size, centroid and the three plants nearest to the centroid."""
    rows, patches = _patches(spark, d)
    at = stage(rows.join(patches, rows.plant_id == patches.id).select("patch", "plant_id", "sector_id", "geo_x", "geo_y"), "patches")
    made = typical_members(at, "patch", "plant_id", "geo_x", "geo_y", ["sector_id"])
    return made.withColumnRenamed("cluster", "patch").withColumns({"cx": F.round("cx", 4), "cy": F.round("cy", 4)})


def p1_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Clusters of about fifty plants by position and sector, with size, spread and the three plants nearest to each centroid."""
    rows, tree = _plants(spark, d)
    return similarity_clusters(rows, "plant_id", tree)


P1_FOUND_SQL = f"""WITH RECURSIVE p AS (SELECT plant_id, sector_id, geo_x AS x, geo_y AS y, floor(geo_x / 0.8) AS cx, floor(geo_y / 0.8) AS cy
    FROM ({COUNTING_SQL}) WHERE {POSITION_SQL} AND sector_id >= 0),
  links AS (SELECT a.plant_id AS a, b.plant_id AS b FROM (SELECT p.*, cx + i AS nx, cy + j AS ny FROM p, (VALUES (-1), (0), (1)) s(i), (VALUES (-1), (0), (1)) t(j)) a
    JOIN p b ON a.sector_id = b.sector_id AND a.nx = b.cx AND a.ny = b.cy AND a.plant_id <> b.plant_id AND sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 0.8),
  reach AS (SELECT a AS node, a AS other FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other),
  roots AS (SELECT node, min(other) AS root, count(*) AS size FROM reach GROUP BY node)
SELECT root AS plant_id_a, node AS plant_id_b FROM roots WHERE size >= 4 AND node <> root"""
P1_PATCHES_SQL = P1_FOUND_SQL[: P1_FOUND_SQL.rindex("SELECT")] + """, m AS (SELECT root AS patch, node AS id, p.sector_id, x, y FROM roots JOIN p ON p.plant_id = node WHERE size >= 4),
  c AS (SELECT patch, any_value(sector_id) AS sector_id, count(*) AS size, avg(x) AS cx, avg(y) AS cy FROM m GROUP BY patch),
  t AS (SELECT m.patch, list(id ORDER BY round(sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy)), 6), id) AS t FROM m JOIN c USING (patch) GROUP BY m.patch)
SELECT patch, sector_id, size, round(cx, 4) AS cx, round(cy, 4) AS cy, t[1] AS typical_1, t[2] AS typical_2, t[3] AS typical_3 FROM c JOIN t USING (patch)"""


def _readings(spark: SparkSession, d: str) -> DataFrame:
    """sector_id, predicted_growth_stage, flight_day, osavi of the rows that count in problem 2."""
    rows = counting_rows(table(spark, d, "pineapple_crops"), "sector_id", "predicted_growth_stage", "flight_date", "osavi")
    rows = rows.where(usable("sector_id") & usable("osavi") & F.col("predicted_growth_stage").isNotNull())
    return rows.select("sector_id", stage_name().alias("predicted_growth_stage"), F.to_date("flight_date").alias("flight_day"), "osavi")


P2_KEYS = ["sector_id", "predicted_growth_stage"]


P2_PROBS = [0.1, 0.25, 0.5, 0.75, 0.9]


def _digests(rows: DataFrame) -> DataFrame:
    return build_digests(rows, [*P2_KEYS, "flight_day"], "osavi", DIGEST)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Groups by the merged digests, each quantile shifted by four times its stated bound; what these leave is decided by counting."""
    rows = stage(_readings(spark, d), "readings")
    # a digest passes four merges here: in the task, of the day, of the group in parts, of the group
    low, high = 0.5 - 4 * rank_bound(0.5, 20, DIGEST), min(1.0, 0.9 + 4 * rank_bound(0.9, 20, DIGEST))
    est = quantiles(_digests(rows), P2_KEYS, [max(0.0, low), high], DIGEST)
    likely = est.groupBy(*P2_KEYS).agg(F.max("n").alias("n"), F.min(F.when(F.col("q") < 0.7, F.col("estimate"))).alias("low"), F.max(F.when(F.col("q") > 0.7, F.col("estimate"))).alias("high"))
    likely = likely.where("n >= 20 AND low <= 0.35 AND high >= 0.70")
    bounds = likely.select(*P2_KEYS, F.explode(F.array(F.struct(F.lit(0.5).alias("q"), F.lit(0.35).alias("estimate")), F.struct(F.lit(0.9).alias("q"), F.lit(0.70).alias("estimate")))).alias("e")).select(*P2_KEYS, "e.q", "e.estimate")
    counted = certify(rows, P2_KEYS, "osavi", bounds)
    sure = counted.groupBy(*P2_KEYS).agg(F.max(F.when(F.col("q") == 0.5, F.col("rank_upto") / F.col("n"))).alias("low"), F.max(F.when(F.col("q") == 0.9, F.col("rank_below") / F.col("n"))).alias("high"))
    return sure.where("low >= 0.5 AND high <= 0.9").select(*P2_KEYS)


def _certified(spark: SparkSession, d: str) -> DataFrame:
    rows = stage(_readings(spark, d), "readings")
    return certified_quantiles(rows, P2_KEYS, "osavi", _digests(rows), P2_PROBS, DIGEST)


def p2_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Five percentiles of osavi a group, with the exact ranks that prove their error and the bound none exceeds."""
    return _certified(spark, d).withColumn("estimate", F.round("estimate", 6))


def p2_checks(spark: SparkSession, d: str) -> DataFrame:
    """Each group's readings, and whether every percentile keeps the stated bound and lies between the group's ends."""
    c = _certified(spark, d).groupBy(*P2_KEYS).agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("quantiles"), F.min(F.col("rank_error") <= F.col("rank_bound")).alias("within_bound"))
    return c.select(*P2_KEYS, "n", "quantiles", "within_bound")


def p2_daily_digests(spark: SparkSession, d: str) -> DataFrame:
    """The digests of each flight day, as they would be stored to be merged later."""
    keys = [*P2_KEYS, "flight_day"]
    return merge_digests(build_digests(_readings(spark, d), keys, "osavi", DIGEST), keys, DIGEST)


_P2_ROWS = f"""r AS (SELECT sector_id, upper(trim(predicted_growth_stage))[1:1] || lower(trim(predicted_growth_stage))[2:] AS predicted_growth_stage, CAST(flight_date AS DATE) AS flight_day, osavi
    FROM ({COUNTING_SQL}) WHERE sector_id >= 0 AND predicted_growth_stage IS NOT NULL AND osavi BETWEEN -1 AND 1)"""
P2_CHECKS_SQL = f"WITH {_P2_ROWS} SELECT sector_id, predicted_growth_stage, count(*) AS n, 5 AS quantiles, true AS within_bound FROM r GROUP BY sector_id, predicted_growth_stage"


def p2_day_totals(spark: SparkSession, d: str) -> DataFrame:
    """What the stored daily digests hold: readings and their mean, which merging must keep."""
    t = p2_daily_digests(spark, d).groupBy(*P2_KEYS, "flight_day").agg(F.sum("weight").cast("long").alias("n"), half_away(F.sum(F.col("mean") * F.col("weight")) / F.sum("weight"), 9).alias("mean"))
    return t.select(*P2_KEYS, "flight_day", "n", "mean")


P2_DAY_TOTALS_SQL = f"WITH {_P2_ROWS} SELECT sector_id, predicted_growth_stage, flight_day, count(*) AS n, round(avg(osavi), 9) AS mean FROM r GROUP BY ALL"
P2_FOUND_SQL = f"""WITH r AS (SELECT sector_id, upper(trim(predicted_growth_stage))[1:1] || lower(trim(predicted_growth_stage))[2:] AS predicted_growth_stage, osavi
    FROM ({COUNTING_SQL}) WHERE sector_id >= 0 AND predicted_growth_stage IS NOT NULL AND osavi BETWEEN -1 AND 1)
SELECT sector_id, predicted_growth_stage FROM r GROUP BY ALL HAVING count(*) >= 20 AND quantile_cont(osavi, 0.5) <= 0.35 AND quantile_cont(osavi, 0.9) >= 0.70"""


def _ranked(spark: SparkSession, d: str) -> DataFrame:
    rows = counting_rows(table(spark, d, "pineapple_crops"), "sector_id", "health_score").where(usable("sector_id") & usable("health_score"))
    return top_n(rows, "sector_id", "health_score", "plant_id", TOP)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _ranked(spark, d).select("sector_id", "plant_id")


def p4_ranked(spark: SparkSession, d: str) -> DataFrame:
    return _ranked(spark, d).select("sector_id", "plant_id", "health_score", F.col("rank").cast("long").alias("rank"))


_P4 = f"""SELECT sector_id, plant_id, health_score, row_number() OVER (PARTITION BY sector_id ORDER BY health_score DESC, plant_id) AS rank
    FROM ({COUNTING_SQL}) WHERE sector_id >= 0 AND health_score BETWEEN 0 AND 100 QUALIFY rank <= 5"""


def _sized(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Size: one token a UTF-8 byte, as the public byte tokenizer counts."""
    return table(spark, d, "documents").select("doc_id", *columns, F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"))


def _packed(spark: SparkSession, d: str) -> DataFrame:
    return pack(_sized(spark, d), "doc_id", "size", table(spark, d, "pack_containers"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """The documents that were cut: those with a second piece."""
    return _packed(spark, d).where("piece = 1").select("container_id", F.col("item").alias("doc_id"))


def p6_assignments(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d)


def p6_fill(spark: SparkSession, d: str) -> DataFrame:
    """Windows used a container, beside the least possible number, and the share of their room that is filled."""
    kinds = F.broadcast(table(spark, d, "pack_containers"))  # pack() refuses more than 1,000 rows
    windows = _packed(spark, d).groupBy("container_id", "window").agg(F.sum("tokens").alias("used")).where("used > 0")
    used = windows.groupBy("container_id").agg(F.count(F.lit(1)).alias("windows"), F.sum("used").alias("tokens")).join(kinds, "container_id")
    return used.select("container_id", "windows", "tokens", F.ceil(F.col("tokens") / F.col("capacity_tokens")).alias("least_windows"), (F.col("tokens") / F.col("capacity_tokens") / F.col("windows")).alias("fill"))


def p6_checks(spark: SparkSession, d: str) -> DataFrame:
    """What must hold for every container: documents, pieces and tokens placed, windows above capacity, items that were cut
    though they fit, documents whose pieces leave a gap or overlap, and whether the windows are at least 95 % full."""
    kinds = F.broadcast(table(spark, d, "pack_containers"))  # pack() refuses more than 1,000 rows
    at = stage(_packed(spark, d).join(kinds, "container_id"), "packed")
    windows = at.groupBy("container_id", "capacity_tokens", "window").agg(F.sum("tokens").alias("used"))
    w = windows.groupBy("container_id").agg(F.count_if(F.col("used") > F.col("capacity_tokens")).alias("overfull"), (F.sum("used") / F.sum(F.when(F.col("used") > 0, F.col("capacity_tokens"))) >= 0.95).alias("well_filled"))
    # pieces of a document must start where the others end: the sums of starts and of what lies before agree only then
    docs = at.groupBy("container_id", "capacity_tokens", "item").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("size"), F.sum("start").alias("starts"), F.max(F.col("start") + F.col("tokens")).alias("stop"))
    whole = (F.col("stop") == F.col("size")) & (F.col("starts") == F.col("capacity_tokens") * F.col("n") * (F.col("n") - 1) / 2)
    i = docs.groupBy("container_id").agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("pieces"), F.sum("size").alias("tokens"), F.count_if((F.col("n") > 1) & (F.col("size") <= F.col("capacity_tokens"))).alias("needless_cuts"), F.count_if(~whole).alias("broken"))
    return i.join(w, "container_id").select("container_id", "documents", "pieces", "tokens", "overfull", "needless_cuts", "broken", "well_filled")


P6_CHECKS_SQL = """SELECT container_id, count(*) AS documents, sum(greatest(1, ceil(size / capacity_tokens)))::BIGINT AS pieces, sum(size)::BIGINT AS tokens, 0 AS overfull, 0 AS needless_cuts, 0 AS broken, true AS well_filled
  FROM pack_containers, (SELECT coalesce(octet_length(encode(text)), 0) AS size FROM documents WHERE doc_id IS NOT NULL) GROUP BY container_id"""
P6_FOUND_SQL = "SELECT container_id, doc_id FROM pack_containers, documents WHERE text IS NOT NULL AND octet_length(encode(text)) > capacity_tokens"


def _mixed(spark: SparkSession, d: str) -> Mix:
    return mix(_sized(spark, d, "source"), "doc_id", "source", "size", table(spark, d, "mix_targets"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d).report.where("short").select("source")


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d).report


def p7_checks(spark: SparkSession, d: str) -> DataFrame:
    """What must hold for every source: exact supply, wanted and possible tokens; the share reached within one point of what
    the caps allow, no more tokens than the cap, and no document's part used more than max_repeats times."""
    made = _mixed(spark, d)
    limit = table(spark, d, "mix_targets").select("source", F.coalesce("max_repeats", F.lit(1)).alias("m"))
    often = made.slots.groupBy("source", "block").agg(F.count(F.lit(1)).alias("n")).groupBy("source").agg(F.max("n").alias("n"))
    r = made.report.join(often, "source", "left").join(F.broadcast(limit), "source")  # targets are bounded by mix()
    near = (F.abs(F.col("actual_share") - F.col("reachable_share")) <= 0.01) & (F.col("drawn_tokens") <= F.col("cap_tokens")) & (F.coalesce("n", F.lit(0)) <= F.col("m"))
    return r.select("source", "supply_tokens", half_away("wanted_tokens", 3).alias("wanted_tokens"), "cap_tokens", "short", near.alias("as_planned"))


def p7_manifest(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d).spans


P7_FOUND_SQL = """WITH s AS (SELECT t.source, t.target_share, t.max_repeats, coalesce((SELECT sum(octet_length(encode(text))) FROM documents d
    WHERE text IS NOT NULL AND lower(trim(d.source)) = lower(trim(t.source))), 0)::BIGINT AS supply FROM mix_targets t)
SELECT source FROM s WHERE supply * max_repeats < target_share::DOUBLE * (SELECT sum(supply) FROM s)"""


P7_CHECKS_SQL = P7_FOUND_SQL[: P7_FOUND_SQL.rindex("SELECT source FROM s")] + """SELECT source, supply AS supply_tokens, round(target_share::DOUBLE * t, 3) AS wanted_tokens, (supply * max_repeats)::BIGINT AS cap_tokens, supply * max_repeats < target_share::DOUBLE * t AS short, true AS as_planned
  FROM s, (SELECT sum(supply) AS t FROM s)"""


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = look_alike_pairs(look_alike_classes(table(spark, d, "documents"), "doc_id", "text"))
    return pairs.select(F.col("a").alias("doc_id_a"), F.col("b").alias("doc_id_b"))


def p8_canonical(spark: SparkSession, d: str) -> DataFrame:
    """Every document of a class with the document whose text stands for all of them."""
    return look_alike_classes(table(spark, d, "documents"), "doc_id", "text").select(F.col("id").alias("doc_id"), "class_id", F.col("canonical_id").alias("canonical_doc_id"))


def _sql_text(t: str) -> str:
    return t.replace("'", "''")


def _same_sql() -> str:
    """DuckDB: the stored texts of each class, by the composed form of the mapped text."""
    one, many, _ = tables()
    order = sorted(one, key=lambda c: not one[c])
    mapped = f"translate(text, '{_sql_text(''.join(order))}', '{_sql_text(''.join(one[c] for c in order))}')"
    for a, b in many.items():
        mapped = f"replace({mapped}, '{a}', '{b}')"
    return f"""t AS (SELECT doc_id, text, octet_length(encode(text)) AS size, md5(nfc_normalize(CASE WHEN octet_length(encode(text)) = length(text) THEN text ELSE {mapped} END)) AS shown FROM documents WHERE doc_id IS NOT NULL AND text <> ''),
  k AS (SELECT shown, arg_min(doc_id, (size, doc_id)) AS class_id FROM t GROUP BY shown HAVING count(DISTINCT md5(text)) > 1)"""


P8_FOUND_SQL = f"WITH {_same_sql()} SELECT DISTINCT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM t a JOIN k USING (shown) JOIN t b ON b.shown = a.shown AND a.doc_id < b.doc_id AND a.text <> b.text"
P8_CANONICAL_SQL = f"WITH {_same_sql()} SELECT DISTINCT doc_id, class_id, class_id AS canonical_doc_id FROM t JOIN k USING (shown)"

QUERIES = {f.__name__: f for f in (p1_found, p1_patches, p1_clusters, p2_found, p2_percentiles, p2_checks, p2_daily_digests, p2_day_totals, p4_found, p4_ranked, p6_found, p6_assignments, p6_fill, p6_checks, p7_found, p7_report, p7_checks, p7_manifest, p8_found, p8_canonical)}
SQL = {"p1_found": P1_FOUND_SQL, "p1_patches": P1_PATCHES_SQL, "p2_found": P2_FOUND_SQL, "p4_found": f"SELECT sector_id, plant_id FROM ({_P4})", "p4_ranked": _P4, "p6_found": P6_FOUND_SQL, "p7_found": P7_FOUND_SQL, "p8_found": P8_FOUND_SQL, "p8_canonical": P8_CANONICAL_SQL, "p6_checks": P6_CHECKS_SQL, "p7_checks": P7_CHECKS_SQL, "p2_checks": P2_CHECKS_SQL, "p2_day_totals": P2_DAY_TOTALS_SQL}
