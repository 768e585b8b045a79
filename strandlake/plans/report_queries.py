"""Queries behind reports and figures, each with its SQL counterpart."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import dna, reads as rd
from ..operators import assign, chimera, comparisons as cp, distances, pooling, qc
from ..sources.shared import numbered
from . import views
from .clone_queries import DESIGN, GRADED, OUTCOME, SHORT, _graded, _short_signatures, fine_designs
from .registry import query


@query("closest_references", views.with_views("""d AS (SELECT doc_id, ref_id, levenshtein(r.sequence, f.sequence) AS d FROM reads r JOIN refs f ON f.block = (doc_id % 5)::VARCHAR),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY d, ref_id) AS rank FROM d) SELECT doc_id, ref_id, d::BIGINT AS distance, rank::BIGINT AS rank FROM k WHERE rank <= 3""", "reads", "refs"))
def closest_references(spark, sf):
    """The three nearest references of a read's block, by distance and name."""
    r = views.spread(views.reads(spark, sf)).select("doc_id", F.col("sequence").alias("q"), (F.col("doc_id") % 5).cast("string").alias("block"))
    f = views.refs(spark, sf).select("block", "ref_id", F.col("sequence").alias("s"))
    pairs = distances.distances_to(r, f, ["block"], "q", "s", "distance").withColumn("distance", F.col("distance").cast("long"))
    order = Window.partitionBy("doc_id").orderBy("distance", "ref_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where("rank <= 3").select("doc_id", "ref_id", "distance", F.col("rank").cast("long").alias("rank"))


@query("flanked_references", views.with_views("SELECT ref_id, md5('GGGGTTTTAC' || sequence || 'CATTTTCCCC') AS flanked_md5, md5(sequence) AS insert_md5 FROM refs WHERE NOT starts_with(sequence, 'GGGGTTTTAC')", "refs"))
def flanked_references(spark, sf):
    """Inserts with constant regions joined on, and taken off again."""
    full = views.refs(spark, sf).where(~F.col("sequence").startswith("GGGGTTTTAC")).select("ref_id", dna.flanked(F.col("sequence"), "GGGGTTTTAC", "CATTTTCCCC").alias("full"))
    return full.select("ref_id", F.md5("full").alias("flanked_md5"), F.md5(dna.unflanked(F.col("full"), "GGGGTTTTAC", "CATTTTCCCC")).alias("insert_md5"))


@query("circular_regions", views.with_views("""d AS (SELECT ref_id, sequence AS s, sequence || sequence AS t, length(sequence) AS n, translate(reverse(sequence), 'ACGT', 'TGCA') AS c FROM refs),
f AS (SELECT ref_id, n, t, strpos(t, 'ACGG') AS b, strpos(substr(t, strpos(t, 'ACGG') + 4, n), 'TTAC') AS e, c || c AS u, strpos(c || c, 'ACGG') AS b2, strpos(substr(c || c, strpos(c || c, 'ACGG') + 4, n), 'TTAC') AS e2 FROM d)
SELECT ref_id, coalesce(CASE WHEN b > 0 AND e > 0 THEN substr(t, b + 4, e - 1) WHEN b2 > 0 AND e2 > 0 THEN substr(u, b2 + 4, e2 - 1) END, '-') AS region FROM f""", "refs"))
def circular_regions(spark, sf):
    r = views.refs(spark, sf)
    return r.select("ref_id", F.coalesce(dna.circular_region(F.col("sequence"), "ACGG", "TTAC"), F.lit("-")).alias("region"))


@query("insert_gate", views.with_views("SELECT clone_id, CASE WHEN kind = 'consensus' AND clone_id % 5 <> 0 AND (1 - error < 0.98 OR clone_id % 7 / 7 < 0.2) THEN 'insert_mismatch' WHEN kind = 'consensus' THEN 'assigned_unique' ELSE 'no_match' END AS status FROM clones", "clones"))
def insert_gate(spark, sf):
    """Assigned reads whose insert is too far from its reference's; unknown inserts stay assigned."""
    c, k = views.clones(spark, sf), F.col("clone_id")
    identity = F.when(k % 5 != 0, 1 - F.col("error"))
    status = F.when(F.col("kind") == "consensus", "assigned_unique").otherwise("no_match")
    return c.select("clone_id", assign.insert_gate(identity, F.when(k % 5 != 0, k % 7 / 7), 0.98, 0.2, status).alias("status"))


@query("recovery_by_fragments", views.with_views(f"""x AS (SELECT * REPLACE ({DESIGN} AS design_key) FROM clones), u AS (SELECT DISTINCT design_key, 1 + substr(design_key, 2)::INT % 4 AS fragments FROM x),
o AS (SELECT design_key, {OUTCOME} AS outcome FROM x WHERE kind <> 'chimera'), b AS (SELECT DISTINCT design_key FROM o WHERE outcome IS NOT NULL AND outcome <> 'Other')
SELECT fragments::BIGINT AS fragments, count(*)::BIGINT AS designs, count(b.design_key)::BIGINT AS recovered FROM u LEFT JOIN b USING (design_key) GROUP BY fragments""", "clones"))
def recovery_by_fragments(spark, sf):
    """Designs and recovered ones by the number of fragments they are made of."""
    c = fine_designs(spark, sf)
    designs = c.select("design_key", (1 + F.substring("design_key", 2, 9).cast("int") % 4).cast("long").alias("fragments")).distinct()
    best = cp.best_outcomes(c.where("kind <> 'chimera'"), cp.clone_outcome()).where("outcome <> 'Other'")
    joined = designs.join(best, "design_key", "left")
    return joined.groupBy("fragments").agg(F.count(F.lit(1)).alias("designs"), F.count("outcome").alias("recovered"))


def _statuses(spark, sf):
    k = F.col("c_custkey")
    r = views.table(spark, sf, "customer").select(F.concat(F.lit("R"), (k % 6).cast("string")).alias("plate_id"), F.concat(F.lit("lib"), (k % 2).cast("string")).alias("library_id"), (k % 45).cast("string").alias("block"))
    return pooling.deconvolve(r, views.pools(spark, sf), views.blocks(spark, sf))


@query("deconvolution_share", views.with_views("""c AS (SELECT c_custkey, 'R' || (c_custkey % 6) AS plate_id, 'lib' || (c_custkey % 2) AS library_id, (c_custkey % 45)::VARCHAR AS block FROM customer),
m AS (SELECT c_custkey, count(DISTINCT culture_plate) AS n FROM c JOIN blocks USING (library_id, block) JOIN pools USING (plate_id, culture_plate) GROUP BY c_custkey),
s AS (SELECT c.plate_id, CASE WHEN c.plate_id NOT IN (SELECT plate_id FROM pools) THEN 'unknown_pcr_plate' WHEN (library_id, block) NOT IN (SELECT (library_id, block) FROM blocks) THEN 'unknown_block' WHEN coalesce(n, 0) = 1 THEN 'resolved' WHEN coalesce(n, 0) = 0 THEN 'unexpected_block' ELSE 'ambiguous' END AS status FROM c LEFT JOIN m USING (c_custkey))
SELECT plate_id, status, count(*)::BIGINT AS reads, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY plate_id), 6) AS percent FROM s GROUP BY plate_id, status""", "blocks", "pools"))
def deconvolution_share(spark, sf):
    """Share of each deconvolution status on each PCR plate."""
    counted = _statuses(spark, sf).groupBy("plate_id", F.col("culture_plate_status").alias("status")).agg(F.count(F.lit(1)).alias("reads"))
    total = F.sum("reads").over(Window.partitionBy("plate_id"))
    return counted.select("plate_id", "status", "reads", F.round(100.0 * F.col("reads") / total, 6).alias("percent"))


@query("weak_sources", views.with_views("""p AS (SELECT culture_plate, count(DISTINCT well_id) AS wells FROM clones WHERE grade <> 'low_depth' GROUP BY culture_plate), m AS (SELECT median(wells) AS middle FROM p)
SELECT culture_plate, wells::BIGINT AS wells, wells < 0.6 * middle AS weak FROM p, m""", "clones"))
def weak_sources(spark, sf):
    """Culture plates that gave far fewer wells than the median plate."""
    p = views.clones(spark, sf).where("grade <> 'low_depth'").groupBy("culture_plate").agg(F.count_distinct("well_id").alias("wells"))
    middle = p.agg(F.percentile("wells", 0.5).alias("middle"))
    return p.crossJoin(F.broadcast(middle)).select("culture_plate", "wells", (F.col("wells") < 0.6 * F.col("middle")).alias("weak"))  # one row


@query("clonality_against_expected", views.with_views("""w AS (SELECT plate_id, well_id, count(DISTINCT sequence_id) AS found FROM clones WHERE grade <> 'low_depth' GROUP BY ALL), x AS (SELECT plate_id, count(DISTINCT library_id || '/' || block) AS expected FROM pools LEFT JOIN blocks USING (culture_plate) GROUP BY plate_id)
SELECT plate_id, count(*)::BIGINT AS wells, count(*) FILTER (WHERE found > expected)::BIGINT AS above, count(*) FILTER (WHERE found = expected)::BIGINT AS equal, count(*) FILTER (WHERE found < expected)::BIGINT AS below FROM w JOIN x USING (plate_id) GROUP BY plate_id""", "clones", "pools", "blocks"))
def clonality_against_expected(spark, sf):
    """Wells with more, as many or fewer clones than the layout expects."""
    pools = views.pools(spark, sf)
    expected = pooling.expected_clones(pools, views.blocks(spark, sf), pools.select("plate_id", F.lit("per_block").alias("clonality")).distinct())
    found = views.clones(spark, sf).where("grade <> 'low_depth'").groupBy("plate_id", "well_id").agg(F.count_distinct("sequence_id").alias("found"))
    told, e = found.join(expected, "plate_id"), F.col("expected_clones")
    return told.groupBy("plate_id").agg(F.count(F.lit(1)).alias("wells"), F.count_if(F.col("found") > e).alias("above"), F.count_if(F.col("found") == e).alias("equal"), F.count_if(F.col("found") < e).alias("below"))


@query("signature_histogram", views.with_views(f"{SHORT} SELECT signature, count(*)::BIGINT AS reads FROM sg GROUP BY signature", "calls"))
def signature_histogram(spark, sf):
    """Reads of each positional signature."""
    s = _short_signatures(spark, sf).where(F.size("signature") > 0)
    return s.groupBy(F.array_join("signature", ">").alias("signature")).agg(F.count(F.lit(1)).alias("reads"))


@query("modal_junctions", views.with_views(f"""{SHORT}, jn AS (SELECT uid, "window" AS j FROM n WHERE before <> name), jc AS (SELECT signature, j, count(*) AS n FROM sg JOIN jn USING (uid) WHERE parents > 1 GROUP BY ALL)
SELECT signature, arg_min(j, -n * 1000000 + j)::BIGINT AS junction FROM jc WHERE signature IN (SELECT signature FROM sg WHERE parents > 1 GROUP BY signature HAVING count(*) >= 3) GROUP BY signature""", "calls"))
def modal_junctions(spark, sf):
    """The most frequent junction of each group, the smallest of equal ones."""
    g = chimera.group_chimeras(_short_signatures(spark, sf), [], 3)
    return g.select(F.array_join("signature", ">").alias("signature"), F.col("junction_window").cast("long").alias("junction"))


@query("graded_index", views.with_views(f"""{GRADED} SELECT clone_id, gr.plate_id, c.well_id, gr.grade, row_number() OVER (ORDER BY gr.plate_id, c.culture_plate, c.well_id, clone_id)::BIGINT AS place FROM gr JOIN clones c USING (clone_id) WHERE gr.grade = 'perfect'""", "clones"))
def graded_index(spark, sf):
    """The index of perfect clones in the order of plate, culture plate and well, places counted from 1."""
    g = _graded(spark, sf).where("grade = 'perfect'")
    return numbered(g, ["plate_id", "culture_plate", "well_id", "clone_id"]).select("clone_id", "plate_id", "well_id", "grade", "place")


@query("mixed_text", views.with_views("SELECT clone_id, (clone_id % 50) || ':G>GT:' || printf('%.4f', clone_id % 4 / 4) || ',' || printf('%.4f', 1 - clone_id % 4 / 4) AS mixed, printf('%d:G>GT', clone_id % 50 + 1) || ' (' || printf('%.2f', clone_id % 4 / 4) || ',' || printf('%.2f', 1 - clone_id % 4 / 4) || ') insert silent' AS described FROM clones", "clones"))
def mixed_text(spark, sf):
    """A mixed position as text for tables and for people."""
    k = F.col("clone_id")
    share = (k % 4 / 4).cast("double")
    m = F.struct((k % 50).cast("int").alias("pos"), F.lit("G").alias("ref"), F.lit("GT").alias("alleles"), F.array(share, 1 - share).alias("fractions"))
    text = rd.describe_mixed(m["pos"], m["ref"], m["alleles"], m["fractions"], F.lit("insert"), F.lit("silent"))
    return views.clones(spark, sf).select("clone_id", qc.format_mixed(F.array(m)).alias("mixed"), text.alias("described"))


@query("record_digests", """SELECT p_partkey, sha256('{"brand":"' || p_brand || '","name":"' || p_name || '","note":null}') AS digest, replace(replace('<' || p_name || '>', '<', '&lt;'), '>', '&gt;') AS html FROM part""")
def record_digests(spark, sf):
    """Digests of canonical JSON, and values made safe for HTML."""
    p = views.table(spark, sf, "part")
    digest = rd.canonical_digest(F.col("p_brand").alias("brand"), F.col("p_name").alias("name"), F.lit(None).cast("string").alias("note"))
    return p.select("p_partkey", digest.alias("digest"), rd.html_value(F.concat(F.lit("<"), "p_name", F.lit(">"))).alias("html"))


@query("layout_summary", views.with_views("SELECT plate_id, count(DISTINCT culture_plate)::BIGINT AS culture_plates, count(DISTINCT library_id || '/' || block)::BIGINT AS blocks FROM pools LEFT JOIN blocks USING (culture_plate) GROUP BY plate_id", "pools", "blocks"))
def layout_summary(spark, sf):
    """Culture plates and blocks behind each PCR plate."""
    joined = views.pools(spark, sf).join(views.blocks(spark, sf), "culture_plate", "left")
    return joined.groupBy("plate_id").agg(F.count_distinct("culture_plate").alias("culture_plates"), F.count_distinct("library_id", "block").alias("blocks"))
