"""Queries on consensus, judgement, pooling, mosaics and comparisons, each with its SQL counterpart."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dna
from ..operators import chimera, clustering, comparisons as cp, consensus, fragments, kmers, pooling, qc
from . import views
from .registry import query


def _long(*names):
    return [F.col(n).cast("long").alias(n) for n in names]


# Groups, pileups, consensus


@query("clone_groups_topn", views.with_views("""g AS (SELECT doc_id::VARCHAR AS uid, 's1' || chr(31) || plate_id || chr(31) || well_id || chr(31) || '' || chr(31) || '' AS gid, plate_id, well_id FROM reads),
k AS (SELECT *, row_number() OVER (PARTITION BY gid ORDER BY sha256('7' || chr(0) || gid || chr(0) || uid), uid) AS rank FROM g)
SELECT plate_id, well_id, uid AS read_uid, rank::BIGINT AS selection_rank FROM k WHERE rank <= 4""", "reads"))
def clone_groups_topn(spark, sf):
    r = views.reads(spark, sf).withColumns({"read_uid": F.col("doc_id").cast("string"), "library_id": F.lit(None).cast("string"), "alias_key": F.lit(None).cast("string")})
    return consensus.select_reads(consensus.group_reads(r), 4, 7).select("plate_id", "well_id", "read_uid", *_long("selection_rank"))


def _placed(spark, sf):
    counted = views.votes(spark, sf).groupBy("group_id", "pos", "kind", "allele").agg(F.count(F.lit(1)).alias("n"))
    base = F.element_at(F.array(*map(F.lit, "ACG")), F.col("pos") % 3 + 1)
    return consensus.places(counted).withColumn("reference_base", base)


PLACES = """c AS (SELECT group_id, pos, kind, allele, count(*) AS n FROM votes GROUP BY ALL),
p AS (SELECT group_id, pos, substr('ACG', (pos % 3 + 1)::INT, 1) AS ref, coalesce(sum(n) FILTER (WHERE kind = 'base'), 0) AS observed, sum(n) AS spanning, coalesce(sum(n) FILTER (WHERE kind = 'del'), 0) AS dels,
coalesce(sum(n) FILTER (WHERE kind = 'low'), 0) AS low, coalesce(max(n) FILTER (WHERE kind = 'base' AND allele = substr('ACG', (pos % 3 + 1)::INT, 1)), 0) AS own,
coalesce(arg_max(allele, n * 1000 - ascii(allele)) FILTER (WHERE kind = 'base'), '') AS winner, coalesce(max(n) FILTER (WHERE kind = 'base'), 0) AS top FROM c GROUP BY group_id, pos)"""


@query("pileup_counts", views.with_views(f"{PLACES} SELECT group_id, pos::BIGINT AS pos, observed::BIGINT AS observed, spanning::BIGINT AS spanning, dels::BIGINT AS deletions, low::BIGINT AS low_quality FROM p", "votes"))
def pileup_counts(spark, sf):
    return _placed(spark, sf).select("group_id", *_long("pos", "observed", "spanning", "deletions", "low_quality"))


@query("majority_call", views.with_views(f"""{PLACES} SELECT group_id, pos::BIGINT AS pos, CASE WHEN observed < 3 AND observed + dels < 3 THEN 'N' WHEN greatest(top, dels) / (observed + dels) < 0.4 THEN 'N' WHEN dels >= top AND dels > 0 THEN '-' ELSE winner END AS call FROM p""", "votes"))
def majority_call(spark, sf):
    s = consensus.ConsensusSettings(caller="majority", min_support=0.4)
    rated = consensus.with_rates(_placed(spark, sf))
    return consensus.allele_calls(rated, s).select("group_id", *_long("pos"), F.col("call.base").alias("call"))


@query("binomial_caller", views.with_views(f"""{PLACES}, g AS (SELECT group_id, least(greatest(avg((observed - own) / observed) FILTER (WHERE observed > 0), 0.002), 0.25) AS err, greatest(count(*) FILTER (WHERE observed > own), 1) AS tests FROM p GROUP BY group_id),
a AS (SELECT c.group_id, c.pos, c.allele, c.n, observed + dels AS depth, err, tests FROM c JOIN p USING (group_id, pos) JOIN g USING (group_id) WHERE kind = 'base'),
t AS (SELECT *, list_sum(list_transform(range(n, (depth + 1)::BIGINT), lambda k: exp(lgamma(depth + 1) - lgamma(k + 1) - lgamma(depth - k + 1) + k * ln(err) + (depth - k) * ln(1 - err)))) AS tail FROM a),
s AS (SELECT group_id, pos, count(*) AS sig, string_agg(allele, '' ORDER BY allele) AS alleles FROM t WHERE n >= 2 AND n / depth >= 0.2 AND n > err * depth AND tail * tests < 0.05 GROUP BY ALL)
SELECT group_id, pos::BIGINT AS pos, CASE WHEN observed < 3 AND observed + dels < 3 THEN 'N' WHEN dels > 0 AND dels / spanning >= 0.6 THEN '-' WHEN observed = 0 OR coalesce(sig, 0) > 1 THEN 'N' WHEN winner = ref THEN winner WHEN sig = 1 AND alleles = winner THEN winner ELSE 'N' END AS call,
CASE WHEN NOT (observed < 3 AND observed + dels < 3) AND NOT (dels > 0 AND dels / spanning >= 0.6) AND sig > 1 THEN alleles ELSE '' END AS alleles FROM p LEFT JOIN s USING (group_id, pos)""", "votes"))
def binomial_caller(spark, sf):
    rated = consensus.with_rates(_placed(spark, sf))
    called = consensus.allele_calls(rated, consensus.ConsensusSettings())
    return called.select("group_id", *_long("pos"), F.col("call.base").alias("call"), F.array_join("call.alleles.allele", "").alias("alleles"))


@query("consensus_path")
def consensus_path(spark, sf):
    """Consensus of the whole reads of one language and length class."""
    r = views.reads(spark, sf).where(F.length("sequence") > 0).withColumns({"group_id": F.concat_ws(":", "plate_id", (F.length("sequence") % 7).cast("string")), "read_uid": F.col("doc_id").cast("string")})
    first = r.groupBy("group_id").agg(F.min(F.struct("doc_id", "sequence"))["sequence"].alias("reference"))
    known = kmers.joined_small(r, kmers.checkpointed(first, "first"), ["group_id"])
    return consensus.build_consensus(known.select("group_id", "read_uid", "reference", "sequence", "quality"), consensus.ConsensusSettings(max_reads=30))


@query("cluster_reads")
def cluster_reads(spark, sf):
    """Clusters of the whole reads of each language, source and length class."""
    d = views.table(spark, sf, "documents").where(F.lower("text").rlike("[a-z]"))  # others have an empty read; the reads need not be made to tell
    length = F.length(views.letters(F.col("text")))  # that of the read
    wells = d.select(F.concat_ws(":", "lang", "source", (length % 11).cast("string")).alias("well_id"), F.col("doc_id").cast("string").alias("read_uid"), views.encoded(F.col("text")).alias("sequence"))
    return clustering.cluster_reads(wells)


# Judgement


@query("qc_metrics", views.with_views("""x AS (SELECT doc_id, r.sequence AS q, f.sequence AS s FROM reads r JOIN refs f ON f.ref_id = 'Block_' || (doc_id % 40 % 5) || '_' || (doc_id % 40)),
m AS (SELECT *, length(q) > 0 AND length(s) > 0 AS ok, levenshtein(q, s) AS d, greatest(length(q), length(s), 1) AS n FROM x)
SELECT doc_id, CASE WHEN ok THEN d ELSE -1 END::BIGINT AS edit_distance, round(CASE WHEN ok THEN 1 - d / n ELSE 0 END, 6) AS identity, round(CASE WHEN ok THEN least(length(s) / length(q), 1) ELSE 0 END, 6) AS query_coverage,
round(CASE WHEN ok THEN least(length(q) / length(s), 1) ELSE 0 END, 6) AS reference_coverage, CASE WHEN abs(length(q) - length(s)) <= 10 THEN 'pass' ELSE 'fail' END AS expected_length,
CASE WHEN length(q) = 0 THEN 'not_evaluable' WHEN length(q) % 3 = 0 THEN 'pass' ELSE 'fail' END AS reading_frame FROM m""", "reads", "refs"))
def qc_metrics(spark, sf):
    key = F.concat(F.lit("Block_"), (F.col("doc_id") % 40 % 5).cast("string"), F.lit("_"), (F.col("doc_id") % 40).cast("string"))
    """Whole reads against whole references."""
    r = views.spread(views.reads(spark, sf)).select("doc_id", key.alias("ref_id"), "sequence")
    joined = r.join(views.refs(spark, sf).select("ref_id", F.col("sequence").alias("reference")), "ref_id")
    told = qc.evaluate(joined, qc.QcSettings(), "", "")
    return told.select("doc_id", *_long("edit_distance"), F.round("identity", 6).alias("identity"), F.round("query_coverage", 6).alias("query_coverage"), F.round("reference_coverage", 6).alias("reference_coverage"), "expected_length", "reading_frame")


STATES = "['pass', 'fail', 'not_evaluable'][({0} % 3 + 1)::INT]"


@query("qc_overall", f"""SELECT o_orderkey, CASE WHEN list_contains(s, 'fail') THEN 'fail' WHEN list_contains(s, 'pass') THEN 'pass' ELSE 'not_evaluable' END AS overall
FROM (SELECT o_orderkey, [{STATES.format('o_orderkey')}, {STATES.format('o_orderkey // 3')}, {STATES.format('o_custkey')}, {STATES.format('o_custkey // 3')}] AS s FROM orders)""")
def qc_overall(spark, sf):
    state = lambda c: F.element_at(F.array(*map(F.lit, ("pass", "fail", "not_evaluable"))), (c % 3 + 1).cast("int"))
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    return views.table(spark, sf, "orders").select("o_orderkey", qc.overall(state(o), state(F.floor(o / 3)), state(c), state(F.floor(c / 3))).alias("overall"))


def _graded(spark, sf):
    k = F.col("clone_id")
    state = lambda m, r: F.when(k % m == r, "fail").otherwise("pass")
    g = qc.grade(F.when(k % 17 == 0, "low_depth").otherwise("consensus_pass"), F.when(k % 19 == 0, "not_evaluable").otherwise("pass"), F.when(k % 5 == 0, 2).otherwise(0), F.when(k % 10 == 0, "oxidative").otherwise("mixed"), state(7, 1), state(7, 2), state(11, 3), state(13, 4), k % 3)
    return views.clones(spark, sf).withColumn("grade", g)


GRADED = """gr AS (SELECT clone_id, plate_id, CASE WHEN clone_id % 17 = 0 OR clone_id % 19 = 0 THEN 'low_depth' WHEN clone_id % 10 = 0 THEN 'mixed_damage' WHEN clone_id % 5 = 0 THEN 'mixed_variants' WHEN clone_id % 7 = 1 THEN 'frameshift' WHEN clone_id % 7 = 2 THEN 'premature_stop'
WHEN clone_id % 11 = 3 THEN 'truncated' WHEN clone_id % 13 = 4 THEN 'mismatched' WHEN clone_id % 3 = 0 THEN 'perfect' ELSE 'screenable' END AS grade FROM clones)"""


@query("grade_ladder", views.with_views(f"{GRADED} SELECT clone_id, grade FROM gr", "clones"))
def grade_ladder(spark, sf):
    return _graded(spark, sf).select("clone_id", "grade")


@query("grade_totals_rollup", views.with_views(f"{GRADED} SELECT coalesce(plate_id, 'all') AS plate_id, grade, count(*)::BIGINT AS clones FROM gr GROUP BY GROUPING SETS ((plate_id, grade), (grade))", "clones"))
def grade_totals_rollup(spark, sf):
    return qc.grade_totals(_graded(spark, sf)).select(F.coalesce("plate_id", F.lit("all")).alias("plate_id"), "grade", "clones")


@query("region_summary", views.with_views("""l AS (SELECT plate_id, 'insert' AS region, clone_id % 4 AS edits, 300 AS n, 1 - clone_id % 4 / 300 AS identity FROM clones UNION ALL SELECT plate_id, 'vector', clone_id % 9, 900, 1 - clone_id % 9 / 900 FROM clones)
SELECT region, coalesce(plate_id, 'all') AS plate_id, count(*)::BIGINT AS clones, round(avg(identity), 6) AS mean_identity, round(median(identity), 6) AS median_identity, round(avg((edits = 0)::INT), 6) AS exact_fraction, round(1000.0 * sum(edits) / sum(n), 6) AS errors_per_kb
FROM l GROUP BY GROUPING SETS ((region), (region, plate_id))""", "clones"))
def region_summary(spark, sf):
    k = F.col("clone_id")
    part = lambda name, m, n: F.struct(F.lit(name).alias("region"), (k % m).alias("edits"), F.lit(n).alias("length"), (1 - k % m / n).alias("identity"))
    long = views.clones(spark, sf).select("plate_id", F.inline(F.array(part("insert", 4, 300), part("vector", 9, 900))))
    told = qc.region_summary(long, [["region"], ["region", "plate_id"]])
    return told.select("region", F.coalesce("plate_id", F.lit("all")).alias("plate_id"), "clones", *[F.round(c, 6).alias(c) for c in ("mean_identity", "median_identity", "exact_fraction", "errors_per_kb")])


MIXED = """mx AS (SELECT doc_id, sequence, unnest([0, 1, 2]) AS j, length(sequence) AS n FROM reads WHERE length(sequence) >= 60),
pos AS (SELECT doc_id, sequence, j, (j * 17 + doc_id % 13)::INT AS p FROM mx), mp AS (SELECT *, substr(sequence, p + 1, 1) AS ref, CASE WHEN substr(sequence, p + 1, 1) = 'G' THEN 'GT' WHEN substr(sequence, p + 1, 1) = 'C' THEN 'AC' WHEN substr(sequence, p + 1, 1) = 'A' THEN 'AG' ELSE 'CT' END AS alleles FROM pos)"""


def _mixed(spark, sf):
    r = views.reads(spark, sf).where(F.length("sequence") >= 60)
    at = lambda j: (F.lit(17 * j) + F.col("doc_id") % 13).cast("int")
    ref = lambda j: F.substring("sequence", at(j) + 1, F.lit(1))
    alleles = lambda j: F.when(ref(j) == "G", "GT").when(ref(j) == "C", "AC").when(ref(j) == "A", "AG").otherwise("CT")
    text = F.concat_ws("|", *[F.concat(at(j).cast("string"), F.lit(":"), ref(j), F.lit(">"), alleles(j), F.lit(":0.25,0.75" if j else "")) for j in range(3)])
    return r.select("doc_id", "sequence", qc.parse_mixed(text).alias("mixed"))


@query("mixed_parse", views.with_views(f"{MIXED} SELECT doc_id, p::BIGINT AS pos, ref, alleles, CASE WHEN j = 0 THEN 0 ELSE 2 END::BIGINT AS shares FROM mp", "reads"))
def mixed_parse(spark, sf):
    rows = _mixed(spark, sf).select("doc_id", F.inline("mixed"))
    return rows.select("doc_id", *_long("pos"), "ref", "alleles", F.size("fractions").cast("long").alias("shares"))


@query("mixed_region", views.with_views(f"""{MIXED} SELECT doc_id, p::BIGINT AS pos, CASE WHEN p < 15 THEN 'flank_5p' WHEN p < 40 THEN 'insert' ELSE 'unplaced' END AS region, (ref IN ('G', 'C')) AS oxidative FROM mp""", "reads"))
def mixed_region(spark, sf):
    span = lambda n, a, b: F.struct(F.lit(n).alias("name"), F.lit(a).alias("start"), F.lit(b).alias("end"))
    rows = _mixed(spark, sf).select("doc_id", F.inline("mixed"))
    return rows.select("doc_id", *_long("pos"), qc.region_of(F.col("pos"), F.array(span("flank_5p", 0, 15), span("insert", 15, 40))).alias("region"), qc.oxidative(F.col("ref"), F.col("alleles")).alias("oxidative"))


AA = "substr('FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG', (16 * (strpos('TCAG', substr({0}, 1, 1)) - 1) + 4 * (strpos('TCAG', substr({0}, 2, 1)) - 1) + strpos('TCAG', substr({0}, 3, 1)))::INT, 1)"
PROTEIN = "array_to_string(list_transform(range(0, 14), lambda i: " + AA.format("substr({0}, 3 * i + 1, 3)") + "), '')"


@query("mixed_effect", views.with_views(f"""{MIXED}, fr AS (SELECT *, substr(sequence, 7, 42) AS orf, replace(alleles, ref, '') AS alt FROM mp),
al AS (SELECT *, substr(substr(sequence, 1, p) || alt || substr(sequence, p + 2), 7, 42) AS changed FROM fr), tr AS (SELECT *, {PROTEIN.format('orf')} AS p0, {PROTEIN.format('changed')} AS p1 FROM al),
ef AS (SELECT doc_id, ref, CASE WHEN p < 6 OR p >= 48 THEN 0 WHEN strpos(left(p1, 13), '*') > 0 THEN 3 WHEN p1 = p0 THEN 1 ELSE 2 END AS e FROM tr)
SELECT doc_id, ['', 'silent', 'missense', 'nonsense'][(max(e) + 1)::INT] AS effect, CASE WHEN bool_and(ref IN ('G', 'C')) THEN 'oxidative' ELSE 'mixed' END AS signature FROM ef GROUP BY doc_id""", "reads"))
def mixed_effect(spark, sf):
    m = _mixed(spark, sf)
    effects = F.transform("mixed", lambda x: qc.protein_effect(F.col("sequence"), x["pos"], x["alleles"], F.lit(6), F.lit(48)))
    flags = F.transform("mixed", lambda x: qc.oxidative(x["ref"], x["alleles"]))
    return m.select("doc_id", qc.worst_effect(effects).alias("effect"), qc.mixed_signature(flags).alias("signature"))


@query("designed_fraction", views.with_views(f"""{MIXED} SELECT doc_id, round(min(CASE WHEN strpos(alleles, ref) = 1 THEN 0.25 WHEN strpos(alleles, ref) = 2 THEN 0.75 ELSE 0 END), 6) AS fraction FROM mp WHERE j > 0 GROUP BY doc_id""", "reads"))
def designed_fraction(spark, sf):
    m = _mixed(spark, sf).withColumn("mixed", F.slice("mixed", 2, 2))
    return m.select("doc_id", F.round(qc.designed_fraction(F.col("mixed")), 6).cast("double").alias("fraction"))


@query("split_grades")
def split_grades(spark, sf):
    key = F.concat(F.lit("Block_"), (F.col("doc_id") % 40 % 5).cast("string"), F.lit("_"), (F.col("doc_id") % 40).cast("string"))
    """Whole reads against whole references whose bases 20 to 70 are the insert."""
    r = views.spread(views.reads(spark, sf)).select("doc_id", key.alias("ref_id"), "sequence")
    joined = r.join(views.refs(spark, sf).select("ref_id", F.col("sequence").alias("reference")), "ref_id")
    return qc.split_grades(joined, (20, 70)).drop("sequence", "reference")


# Mosaics


@query("signature_collapse", views.with_views("""n AS (SELECT *, lag(name) OVER (PARTITION BY read_uid ORDER BY "window") AS before FROM calls WHERE name IS NOT NULL)
SELECT c.read_uid, coalesce(s, '') AS signature FROM (SELECT DISTINCT read_uid FROM calls) c LEFT JOIN (SELECT read_uid, string_agg(name, '>' ORDER BY "window") AS s FROM n WHERE before IS NULL OR before <> name GROUP BY read_uid) USING (read_uid)""", "calls"))
def signature_collapse(spark, sf):
    return chimera.signatures(views.signature_windows(spark, sf)).select("read_uid", F.array_join("signature", ">").alias("signature"))


@query("junctions", views.with_views("""n AS (SELECT *, lag(name) OVER (PARTITION BY read_uid ORDER BY "window") AS before FROM calls WHERE name IS NOT NULL)
SELECT read_uid, string_agg("window"::VARCHAR, ',' ORDER BY "window") AS junctions FROM n WHERE before <> name GROUP BY read_uid""", "calls"))
def junctions(spark, sf):
    s = chimera.signatures(views.signature_windows(spark, sf)).where(F.size("junctions") > 0)
    return s.select("read_uid", F.array_join(F.transform("junctions", lambda j: j.cast("string")), ",").alias("junctions"))


def _short_signatures(spark, sf):
    """Calls of at most three windows each, so that signatures recur."""
    c = views.signature_windows(spark, sf)
    part = F.concat("read_uid", F.lit("/"), (F.col("window") % 13).cast("string"))
    return chimera.signatures(c.withColumn("read_uid", part))


SHORT = """x AS (SELECT read_uid || '/' || ("window" % 13) AS uid, "window", name FROM calls), n AS (SELECT *, lag(name) OVER (PARTITION BY uid ORDER BY "window") AS before FROM x WHERE name IS NOT NULL),
sg AS (SELECT uid, string_agg(name, '>' ORDER BY "window") AS signature, count(*) AS parents, count(DISTINCT split_part(name, '_', 2)) AS blocks FROM n WHERE before IS NULL OR before <> name GROUP BY uid)"""


@query("chimera_groups", views.with_views(f"{SHORT} SELECT signature, count(*)::BIGINT AS size, CASE WHEN any_value(blocks) = 1 THEN 'assembly' ELSE 'pcr' END AS origin FROM sg WHERE parents > 1 GROUP BY signature HAVING count(*) >= 3", "calls"))
def chimera_groups(spark, sf):
    g = chimera.group_chimeras(_short_signatures(spark, sf), [], 3)
    return g.select(F.array_join("signature", ">").alias("signature"), *_long("size"), "origin")


@query("chimera_outcomes", views.with_views(f"""{SHORT}, al AS (SELECT u.uid, signature, coalesce(parents, 0) AS parents FROM (SELECT DISTINCT uid FROM x) u LEFT JOIN sg USING (uid)), z AS (SELECT *, count(*) OVER (PARTITION BY signature) AS n FROM al)
SELECT CASE parents WHEN 0 THEN 'unmatched' WHEN 1 THEN 'uniform' ELSE 'chimeric_read' END AS outcome, count(*)::BIGINT AS n FROM z GROUP BY 1
UNION ALL SELECT CASE WHEN n >= 3 THEN 'in_group' ELSE 'below_depth' END, count(*)::BIGINT FROM z WHERE parents > 1 GROUP BY 1
UNION ALL SELECT CASE WHEN b = 1 THEN 'group_assembly' ELSE 'group_pcr' END, count(*)::BIGINT FROM (SELECT signature, any_value(blocks) AS b FROM sg WHERE parents > 1 GROUP BY signature HAVING count(*) >= 3) GROUP BY 1""", "calls"))
def chimera_outcomes(spark, sf):
    s = _short_signatures(spark, sf)
    return chimera.outcomes(s, chimera.group_chimeras(s, [], 3), []).select("outcome", F.col("count").alias("n"))


@query("chimera_windows")
def chimera_windows(spark, sf):
    r = views.spread(views.reads(spark, sf)).where(F.length("sequence") >= 90)
    inserts = r.select(F.col("doc_id").cast("string").alias("read_uid"), F.lit("all").alias("library_id"), F.col("sequence").alias("insert"))
    from ..operators import kmers

    groups = kmers.alias_groups(views.refs(spark, sf).withColumn("library_id", F.lit("all")))
    return chimera.signatures(chimera.window_calls(inserts, groups, 15)).select("read_uid", F.size("windows").alias("windows"), F.array_join("signature", ">").alias("signature"))


# Pools and layouts


@query("deconvolution_status", views.with_views("""c AS (SELECT c_custkey, 'R' || (c_custkey % 6) AS plate_id, 'lib' || (c_custkey % 2) AS library_id, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE (c_custkey % 45)::VARCHAR END AS block FROM customer),
m AS (SELECT c_custkey, list(DISTINCT culture_plate) AS hits FROM c JOIN blocks USING (library_id, block) JOIN pools USING (plate_id, culture_plate) GROUP BY c_custkey),
s AS (SELECT c.*, coalesce(len(hits), 0) AS n, hits, plate_id IN (SELECT plate_id FROM pools) AS known, (library_id, block) IN (SELECT (library_id, block) FROM blocks) AS placed FROM c LEFT JOIN m USING (c_custkey))
SELECT c_custkey, CASE WHEN block IS NULL THEN 'unknown_block' WHEN NOT known THEN 'unknown_pcr_plate' WHEN NOT placed THEN 'unknown_block' WHEN n = 1 THEN 'resolved' WHEN n = 0 THEN 'unexpected_block' ELSE 'ambiguous' END AS status,
CASE WHEN block IS NOT NULL AND known AND n = 1 THEN hits[1] END AS culture_plate FROM s""", "blocks", "pools"))
def deconvolution_status(spark, sf):
    k = F.col("c_custkey")
    r = views.table(spark, sf, "customer").select(k, F.concat(F.lit("R"), (k % 6).cast("string")).alias("plate_id"), F.concat(F.lit("lib"), (k % 2).cast("string")).alias("library_id"), F.when(k % 9 != 0, (k % 45).cast("string")).alias("block"))
    return pooling.deconvolve(r, views.pools(spark, sf), views.blocks(spark, sf)).select("c_custkey", F.col("culture_plate_status").alias("status"), "culture_plate")


@query("pool_conflicts", views.with_views("""SELECT 'pooled_without_blocks' AS problem, culture_plate AS subject FROM (SELECT DISTINCT culture_plate FROM pools) ANTI JOIN blocks USING (culture_plate)
UNION ALL SELECT 'blocks_not_pooled', culture_plate FROM (SELECT DISTINCT culture_plate FROM blocks) ANTI JOIN (SELECT * FROM pools WHERE plate_id <> 'R1') p USING (culture_plate)
UNION ALL SELECT 'block_shared_in_pool', plate_id || '/' || library_id || '/' || block FROM pools JOIN blocks USING (culture_plate) WHERE plate_id <> 'R1' GROUP BY plate_id, library_id, block HAVING count(DISTINCT culture_plate) > 1""".replace("FROM pools) ANTI", "FROM pools WHERE plate_id <> 'R1') ANTI"), "pools", "blocks"))
def pool_conflicts(spark, sf):
    return pooling.pool_conflicts(views.pools(spark, sf).where("plate_id <> 'R1'"), views.blocks(spark, sf))


@query("layout_checks", views.with_views("""lay AS (SELECT DISTINCT plate_id, culture_plate, library_id, block FROM pools JOIN blocks USING (culture_plate)), bl AS (SELECT DISTINCT library_id, block FROM lay), rf AS (SELECT DISTINCT library_id, block FROM refs),
bc AS (SELECT unnest(['R0', 'R1', 'R2', 'R3']) AS plate_id), rt AS (SELECT unnest(['R0', 'R1', 'R2']) AS plate_id, 'lib0' AS library_id)
SELECT 'block_without_plate' AS problem, library_id || '/' || block AS subject FROM rf ANTI JOIN bl USING (library_id, block) UNION ALL SELECT 'block_without_reference', library_id || '/' || block FROM bl ANTI JOIN rf USING (library_id, block)
UNION ALL SELECT 'plate_without_barcode', plate_id FROM (SELECT DISTINCT plate_id FROM lay) ANTI JOIN bc USING (plate_id) UNION ALL SELECT 'plate_without_route', plate_id FROM (SELECT DISTINCT plate_id FROM lay) ANTI JOIN rt USING (plate_id)
UNION ALL SELECT 'library_not_routed', plate_id || '/' || library_id FROM (SELECT DISTINCT plate_id, library_id FROM lay) ANTI JOIN rt USING (plate_id, library_id)""", "pools", "blocks", "refs"))
def layout_checks(spark, sf):
    layout = views.pools(spark, sf).join(views.blocks(spark, sf), "culture_plate")
    barcodes = spark.createDataFrame([(f"R{i}",) for i in range(4)], "barcode_id string")
    routes = spark.createDataFrame([(f"R{i}", "lib0") for i in range(3)], "plate_id string, library_id string")
    return pooling.layout_problems(layout, barcodes, routes, views.refs(spark, sf))


@query("expected_clones", views.with_views("SELECT plate_id, CASE WHEN plate_id <> 'R2' THEN count(DISTINCT library_id || '/' || block) ELSE -1 END::BIGINT AS expected_clones FROM pools LEFT JOIN blocks USING (culture_plate) GROUP BY plate_id", "pools", "blocks"))
def expected_clones(spark, sf):
    clonality = views.pools(spark, sf).select("plate_id", F.when(F.col("plate_id") != "R2", "per_block").otherwise("scraped").alias("clonality")).distinct()
    return pooling.expected_clones(views.pools(spark, sf), views.blocks(spark, sf), clonality).select("plate_id", F.coalesce("expected_clones", F.lit(-1)).cast("long").alias("expected_clones"))


@query("culture_recovery", views.with_views("""e AS (SELECT plate_id, well_id, clone_id, grade, unnest([culture_plate, design_key]) AS source FROM clones)
SELECT plate_id, well_id, count(DISTINCT source) FILTER (WHERE grade <> 'low_depth')::BIGINT AS sources, count(DISTINCT clone_id) FILTER (WHERE grade <> 'low_depth')::BIGINT AS consensus, count(*) FILTER (WHERE grade = 'low_depth')::BIGINT AS below_depth FROM e GROUP BY ALL""", "clones"))
def culture_recovery(spark, sf):
    c = views.clones(spark, sf).select("plate_id", "well_id", F.concat_ws("|", "culture_plate", "design_key").alias("culture_plate"), F.col("clone_id").alias("consensus_id"), F.col("grade").alias("status"))
    return pooling.culture_recovery(c)


@query("plate_grid", views.with_views("""w AS (SELECT chr((65 + i // 12)::INT) || lpad((i % 12 + 1)::VARCHAR, 2, '0') AS well_id FROM range(96) t(i)), h AS (SELECT plate_id, well_id, count(DISTINCT clone_id) AS n FROM clones GROUP BY ALL)
SELECT plate_id, well_id, coalesce(n, 0)::BIGINT AS clones FROM (SELECT * FROM (SELECT DISTINCT plate_id FROM clones), w) g LEFT JOIN h USING (plate_id, well_id)""", "clones"))
def plate_grid(spark, sf):
    return pooling.plate_grid(views.clones(spark, sf))


# Replicates and platforms


WELLS = """l AS (SELECT well_id, identity, max(sequence) AS s FROM side0 GROUP BY ALL), r AS (SELECT well_id, identity, max(sequence) AS s FROM side1 GROUP BY ALL),
j AS (SELECT coalesce(l.well_id, r.well_id) AS well_id, count(l.identity) AS nl, count(r.identity) AS nr, count(*) FILTER (WHERE l.identity = r.identity) AS shared, count(*) FILTER (WHERE l.s = r.s AND l.s <> '') AS exact FROM l FULL JOIN r ON l.well_id = r.well_id AND l.identity = r.identity GROUP BY 1),
k AS (SELECT *, CASE WHEN shared > 0 AND exact = shared THEN 'matched_exact' WHEN shared > 0 THEN 'matched_different_sequence' WHEN nl > 0 AND nr > 0 THEN 'different_design' WHEN nl > 0 THEN 'dedicated_only' ELSE 'pool_only' END AS category FROM j)"""


@query("replicate_wells", views.with_views(f"{WELLS} SELECT well_id, category, shared::BIGINT AS shared, exact::BIGINT AS exact FROM k", "side0", "side1"))
def replicate_wells(spark, sf):
    told = cp.compare_wells(views.wells(spark, sf, 0), views.wells(spark, sf, 1), ["well_id"])
    return told.select("well_id", "category", F.size("shared").cast("long").alias("shared"), F.size("exact").cast("long").alias("exact"))


@query("replicate_concordance", views.with_views(f"""{WELLS} SELECT count(*)::BIGINT AS wells, {", ".join(f"count(*) FILTER (WHERE category = '{c}')::BIGINT AS {c}" for c in ("matched_exact", "matched_different_sequence", "different_design", "dedicated_only", "pool_only"))},
round(count(*) FILTER (WHERE category LIKE 'matched%') / count(*) FILTER (WHERE category <> 'pool_only'), 6) AS matched_fraction FROM k""", "side0", "side1"))
def replicate_concordance(spark, sf):
    told = cp.concordance(cp.compare_wells(views.wells(spark, sf, 0), views.wells(spark, sf, 1), ["well_id"]))
    return told.withColumn("matched_fraction", F.round("matched_fraction", 6))


@query("pairing_check", views.with_views("""c AS (SELECT culture_plate, 'lib' || (clone_id % 2) AS library_id, (clone_id % 40)::VARCHAR AS block FROM clones), k AS (SELECT c.*, EXISTS (SELECT 1 FROM blocks b WHERE b.library_id = c.library_id AND b.block = c.block AND b.culture_plate = c.culture_plate) AS fits FROM c SEMI JOIN blocks USING (library_id, block))
SELECT culture_plate, count(*)::BIGINT AS clones, count(*) FILTER (WHERE fits)::BIGINT AS fitting, round(count(*) FILTER (WHERE fits) / count(*), 6) AS fraction FROM k GROUP BY culture_plate""", "clones", "blocks"))
def pairing_check(spark, sf):
    c = views.clones(spark, sf).select("culture_plate", F.concat(F.lit("lib"), (F.col("clone_id") % 2).cast("string")).alias("library_id"), (F.col("clone_id") % 40).cast("string").alias("block"))
    return cp.pairing_check(c, views.blocks(spark, sf)).withColumn("fraction", F.round("fraction", 6))


@query("replicate_partners", views.with_views("SELECT a.culture_plate, a.well_id, a.block AS plate_a, b.block AS plate_b FROM (SELECT DISTINCT culture_plate, well_id, block::VARCHAR AS block FROM clones) a JOIN (SELECT DISTINCT culture_plate, well_id, block::VARCHAR AS block FROM clones) b ON a.culture_plate = b.culture_plate AND a.well_id = b.well_id AND a.block <> b.block", "clones"))
def replicate_partners(spark, sf):
    return cp.partners(views.clones(spark, sf).select("culture_plate", "well_id", F.col("block").cast("string").alias("plate_id")).distinct())


@query("wells_per_block", views.with_views("SELECT block, count(DISTINCT culture_plate || '/' || well_id)::BIGINT AS wells FROM clones GROUP BY block", "clones"))
def wells_per_block(spark, sf):
    return cp.wells_per_block(views.clones(spark, sf))


@query("apportionment", views.with_views("""o AS (SELECT culture_plate, block, count(DISTINCT well_id) AS n FROM clones GROUP BY ALL), q AS (SELECT *, 96 * n / sum(n) OVER (PARTITION BY culture_plate) AS quota FROM o),
f AS (SELECT *, floor(quota) AS w, 96 - sum(floor(quota)) OVER (PARTITION BY culture_plate) AS spare, row_number() OVER (PARTITION BY culture_plate ORDER BY quota - floor(quota) DESC, block) AS place FROM q)
SELECT block, sum(w + CASE WHEN place <= spare THEN 1 ELSE 0 END)::BIGINT AS wells FROM f GROUP BY block""", "clones"))
def apportionment(spark, sf):
    return cp.allocated_wells(views.clones(spark, sf), 96).select("block", *_long("wells"))


@query("histogram_wells", views.with_views("""p AS (SELECT culture_plate, well_id, least(count(DISTINCT sequence_id), 3) AS sequences FROM clones GROUP BY ALL), h AS (SELECT sequences, count(*) AS wells FROM p GROUP BY sequences)
SELECT sequences::BIGINT AS sequences, wells::BIGINT AS wells FROM h UNION ALL SELECT 0, (25 * 2000 - sum(wells))::BIGINT FROM h""", "clones"))
def histogram_wells(spark, sf):
    return cp.sequences_per_well(views.clones(spark, sf), 25, 2000).select(*_long("sequences", "wells"))


OUTCOME = "coalesce(insert_class, CASE WHEN grade = 'perfect' THEN 'Perfect' WHEN grade IN ('screenable', 'mixed_damage') THEN 'Screenable' WHEN grade = 'low_depth' THEN NULL ELSE 'Other' END)"


@query("recovery_best", views.with_views(f"o AS (SELECT design_key, {OUTCOME} AS outcome FROM clones WHERE kind <> 'chimera') SELECT design_key, ['Perfect', 'Screenable', 'Other'][min(list_position(['Perfect', 'Screenable', 'Other'], outcome))] AS outcome FROM o WHERE outcome IS NOT NULL GROUP BY design_key", "clones"))
def recovery_best(spark, sf):
    return cp.best_outcomes(views.clones(spark, sf).where("kind <> 'chimera'"), cp.clone_outcome())


@query("population_fractions", views.with_views(f"o AS (SELECT {OUTCOME} AS outcome FROM clones WHERE kind <> 'chimera') SELECT outcome, count(*)::BIGINT AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent FROM o WHERE outcome IS NOT NULL GROUP BY outcome", "clones"))
def population_fractions(spark, sf):
    return cp.population_fractions(views.clones(spark, sf).where("kind <> 'chimera'"), cp.clone_outcome()).withColumn("percent", F.round("percent", 6))


@query("identity_summary", views.with_views("SELECT plate_id, count(*)::BIGINT AS n, round(avg(1 - error), 6) AS mean, round(median(1 - error), 6) AS median, round(avg((error = 0)::INT), 6) AS exact_fraction FROM clones GROUP BY plate_id", "clones"))
def identity_summary(spark, sf):
    told = cp.identity_summary(views.clones(spark, sf).withColumn("identity", 1 - F.col("error")), ["plate_id"])
    return told.select("plate_id", "n", *[F.round(c, 6).alias(c) for c in ("mean", "median", "exact_fraction")])


@query("hash_subsample", views.with_views("""k AS (SELECT clone_id, block, row_number() OVER (PARTITION BY block ORDER BY sha256(clone_id || ':11'), clone_id) AS rank FROM clones) SELECT clone_id, block FROM k WHERE rank <= 20 + block""", "clones"))
def hash_subsample(spark, sf):
    c = views.clones(spark, sf).select("clone_id", "block")
    return cp.hash_sample(c, c.select("block", (F.col("block") + 20).alias("depth")).distinct(), ["block"], "clone_id", 11).select("clone_id", "block")


@query("rarefaction", views.with_views("""w AS (SELECT plate_id, design_key, count(DISTINCT culture_plate || well_id) AS weight FROM clones GROUP BY ALL), t AS (SELECT plate_id, count(DISTINCT culture_plate || well_id) AS total FROM clones GROUP BY plate_id),
d AS (SELECT *, unnest([10, 50, 100]) AS drawn FROM w JOIN t USING (plate_id))
SELECT plate_id, drawn::BIGINT AS drawn, round(sum(CASE WHEN drawn >= total OR total - weight < drawn THEN 1.0 ELSE 1 - exp(lgamma(total - weight + 1) - lgamma(total - weight - drawn + 1) - lgamma(total + 1) + lgamma(total - drawn + 1)) END), 6) AS expected FROM d GROUP BY ALL""", "clones"))
def rarefaction(spark, sf):
    c = views.clones(spark, sf)
    w = c.groupBy("plate_id", "design_key").agg(F.count_distinct("culture_plate", "well_id").alias("weight"))
    t = c.groupBy("plate_id").agg(F.count_distinct("culture_plate", "well_id").alias("total"))
    return cp.rarefaction(w.join(t, "plate_id"), ["plate_id"], "total", [10, 50, 100]).select("plate_id", *_long("drawn"), F.round("expected", 6).alias("expected"))


#: Designs fine enough that some are found on one side only.
DESIGN = "'d' || (clone_id % 4001)"
SIDES = f"o AS (SELECT {DESIGN} AS design_key, clone_id % 2 AS side, {OUTCOME} AS outcome FROM clones WHERE kind <> 'chimera'), b AS (SELECT side, design_key, min(list_position(['Perfect', 'Screenable', 'Other'], outcome)) AS r FROM o WHERE outcome IS NOT NULL GROUP BY ALL), n AS (SELECT side, design_key, ['Perfect', 'Screenable', 'Other'][r] AS outcome FROM b)"


def fine_designs(spark, sf):
    return views.clones(spark, sf).withColumn("design_key", F.concat(F.lit("d"), (F.col("clone_id") % 4001).cast("string")))


def _sides(spark, sf):
    c = fine_designs(spark, sf).where("kind <> 'chimera'")
    return [cp.best_outcomes(c.where(F.col("clone_id") % 2 == s), cp.clone_outcome()) for s in (0, 1)]


@query("encoding_matrix", views.with_views(f"""{SIDES}, m AS (SELECT coalesce(x.outcome, 'absent') AS a, coalesce(y.outcome, 'absent') AS b FROM (SELECT * FROM n WHERE side = 0) x FULL JOIN (SELECT * FROM n WHERE side = 1) y USING (design_key)),
c AS (SELECT a, b, count(*) AS n FROM m GROUP BY ALL) SELECT a, b, n::BIGINT AS n, round(sum(n) OVER (PARTITION BY a) * sum(n) OVER (PARTITION BY b) / sum(n) OVER (), 6)::DOUBLE AS expected FROM c""", "clones"))
def encoding_matrix(spark, sf):
    a, b = _sides(spark, sf)
    return cp.outcome_matrix(a, b, [*cp.OUTCOMES, "absent"]).withColumn("expected", F.round("expected", 6))


@query("structural_sets", views.with_views(f"""{SIDES}, u AS (SELECT DISTINCT {DESIGN} AS design_key FROM clones), f AS (SELECT design_key IN (SELECT design_key FROM n WHERE side = 0) AS a, design_key IN (SELECT design_key FROM n WHERE side = 1) AS b FROM u)
SELECT count(*) FILTER (WHERE a AND NOT b)::BIGINT AS only_a, count(*) FILTER (WHERE b AND NOT a)::BIGINT AS only_b, count(*) FILTER (WHERE a AND b)::BIGINT AS both, count(*) FILTER (WHERE NOT a AND NOT b)::BIGINT AS neither FROM f""", "clones"))
def structural_sets(spark, sf):
    a, b = _sides(spark, sf)
    return cp.structural_sets(a, b, fine_designs(spark, sf))


@query("heterogeneity_bands", views.with_views("""c AS (SELECT group_id, pos, allele, CASE WHEN substr(group_id, 2)::INT % 2 = 0 THEN 'l' ELSE 'r' END AS side, substr(group_id, 2)::INT // 2 AS clone, count(*) AS n FROM votes WHERE kind = 'base' GROUP BY ALL),
d AS (SELECT clone, side, pos, allele, n, sum(n) OVER (PARTITION BY group_id, pos) AS depth, n / sum(n) OVER (PARTITION BY group_id, pos) AS share, substr('ACG', (pos % 3 + 1)::INT, 1) AS ref FROM c),
j AS (SELECT l.clone, l.pos, l.allele, l.ref, l.share AS ls, r.share AS rs FROM d l JOIN d r ON l.side = 'l' AND r.side = 'r' AND l.clone = r.clone AND l.pos = r.pos AND l.allele = r.allele WHERE l.depth >= 10 AND r.depth >= 10 AND l.allele <> l.ref)
SELECT clone::BIGINT AS clone, pos::BIGINT AS pos, allele, CASE WHEN least(ls, rs) >= 0.2 THEN 'shared' WHEN least(ls, rs) < 0.05 THEN 'one_sided' ELSE 'ambiguous' END AS verdict,
CASE WHEN ref || '>' || allele IN ('G>T', 'C>A') THEN 'oxidative' WHEN ref || '>' || allele IN ('A>G', 'G>A', 'C>T', 'T>C') THEN 'transition' ELSE 'transversion' END AS class FROM j WHERE greatest(ls, rs) >= 0.2 AND greatest(ls, rs) <= 0.95""", "votes"))
def heterogeneity_bands(spark, sf):
    number = F.substring("group_id", 2, 9).cast("int")
    counted = views.votes(spark, sf).where("kind = 'base'").groupBy("group_id", F.col("pos").alias("position"), "allele").agg(F.count(F.lit(1)).alias("n"))
    facts = cp.position_facts(counted, ["group_id"])
    rows = facts.select((number % 2).alias("side"), F.floor(number / 2).alias("clone"), "position", "depth", F.inline("shares")).withColumn("reference_base", F.element_at(F.array(*map(F.lit, "ACG")), F.col("position") % 3 + 1))
    told = cp.heterogeneity(rows.where("side = 0"), rows.where("side = 1"), ["clone"], 10)
    return told.select(*_long("clone"), F.col("position").cast("long").alias("pos"), "allele", "verdict", "class")


@query("recovery_gain", views.with_views("""s AS (SELECT count(DISTINCT design_key) FILTER (WHERE clone_id % 6 = 0) AS sa, count(DISTINCT design_key) FILTER (WHERE clone_id % 6 IN (0, 3)) AS su, count(DISTINCT design_key) FILTER (WHERE clone_id % 2 = 0) AS ea, count(DISTINCT design_key) AS eu FROM clones)
SELECT round(100.0 * (su - sa) / 211, 6) AS headline, round(100.0 * (eu - ea) / 211, 6) AS structural, round(100.0 * (su - sa) / 211 - 100.0 * (eu - ea) / 211, 6) AS oversampling FROM s""", "clones"))
def recovery_gain(spark, sf):
    n = lambda when: F.count_distinct(F.when(when, F.col("design_key")))
    k = F.col("clone_id")
    s = views.clones(spark, sf).agg(n(k % 6 == 0).alias("sa"), n((k % 6).isin(0, 3)).alias("su"), n(k % 2 == 0).alias("ea"), n(k.isNotNull()).alias("eu"))
    g = s.select(cp.gain_decomposition(F.col("sa"), F.col("su"), F.col("ea"), F.col("eu"), F.lit(211)).alias("g")).select("g.*")
    return g.select(*[F.round(c, 6).alias(c) for c in g.columns])


@query("permutation_gc")
def permutation_gc(spark, sf):
    r = views.reads(spark, sf).select(dna.gc_percent(F.col("sequence")).alias("v"), (F.col("plate_id") == "en").alias("l"))
    return cp.permutation_test(r, "v", "l", 40, 5)


@query("status_counts", views.with_views("SELECT grade, kind, count(*)::BIGINT AS n FROM clones GROUP BY ALL", "clones"))
def status_counts(spark, sf):
    return views.clones(spark, sf).groupBy("grade", "kind").agg(F.count(F.lit(1)).alias("n"))


# Designs


def _oligos(spark, sf):
    """Whole reads as genes and the two oligos that assemble each: halves with outer overhangs between a site pair."""
    r = views.reads(spark, sf).where(F.length("sequence") >= 60)
    gene = F.concat(F.lit("AATT"), "sequence", F.lit("CCGG"))
    half = F.floor(F.length(gene) / 2).cast("int") + 2
    wrap = lambda body: F.concat(F.lit("GGTCTCA"), body, F.lit("TGAGACC"))
    return r.select(F.col("doc_id").cast("string").alias("gene_id"), F.col("plate_id").alias("block"), F.array(wrap(F.substring(gene, F.lit(1), half)), wrap(F.substring(gene, half - 3, F.length(gene)))).alias("oligos"), F.col("sequence").alias("gene"))


@query("fragment_assembly")
def fragment_assembly(spark, sf):
    return fragments.assembled_fragments(views.spread(_oligos(spark, sf))).select("gene_id", "block", "n_slots", "assembled", F.size("pieces").alias("n_pieces"))


@query("assembly_errors")
def assembly_errors(spark, sf):
    """Reads made of the first half of one design and the second half of the next are found as chimeric."""
    own = views.table(spark, sf, "benchmark").select(F.col("item_id"), views.encoded(F.col("text")).alias("sequence")).where(F.length("sequence") >= 60)
    half = F.floor(F.length("sequence") / 2).cast("int")
    pieces = own.select(F.lit("b").alias("block"), F.col("item_id").cast("string").alias("gene_id"), F.inline(F.array(F.struct(F.lit(0).alias("slot"), F.substring(F.col("sequence"), F.lit(1), half).alias("sequence")), F.struct(F.lit(1).alias("slot"), F.substring(F.col("sequence"), half + 1, F.length("sequence")).alias("sequence")))))
    parts = pieces.select(F.concat(F.lit("r"), F.when((F.col("slot") == 1) & (F.col("gene_id").cast("int") % 3 == 0), (F.col("gene_id").cast("int") + 1).cast("string")).otherwise(F.col("gene_id"))).alias("uid"), "block", "slot", F.col("sequence").alias("part")).dropDuplicates(["uid", "slot"])
    owners = fragments.slot_owners(parts, pieces)
    slots = spark.createDataFrame([("b", 2)], "block string, n_slots int")
    return fragments.assembly_outcome(owners, slots).select("uid", "found", F.array_join("owners", "+").alias("owners"), "outcome")
