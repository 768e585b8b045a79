"""Queries on sequences, barcodes, k-mers and assignment, each with its SQL counterpart."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import dna, protein, reads as rd
from ..operators import assign, demux, distances, fragments, kmers, motifs, pooling
from ..sources.shared import numbered
from . import views
from .registry import query

RC = "translate(reverse({0}), 'ACGT', 'TGCA')"
PLATE = demux.CallSettings(window=40, max_edits=4, min_margin=1, ends=("head",), both_strands=False)
GATES = demux.Gates(min_length=200, max_length=20_000, min_quality=12.0)
#: The least edits (5: more than 4) of each barcode against any part of the first 40 bases.
INFIX = """w AS (SELECT doc_id, substr(sequence, 1, 40) AS head FROM tagged),
p AS (SELECT doc_id, unnest(range(1, 41)) AS b, head FROM w), s AS (SELECT DISTINCT doc_id, b, unnest(range(20, 29)) AS n, head FROM p),
e AS (SELECT doc_id, substr(head, b, n) AS part FROM s WHERE b + n <= 42),
dist AS (SELECT doc_id, barcode_id, least(min(levenshtein(part, sequence)), 5) AS d FROM (SELECT DISTINCT * FROM e), panel GROUP BY ALL)"""


def _long(*names):
    return [F.col(n).cast("long").alias(n) for n in names]


@query("normalize_revcomp", views.with_views(f"SELECT doc_id, length(sequence)::BIGINT AS n, md5(sequence) AS forward, md5({RC.format('sequence')}) AS reverse FROM reads", "reads"))
def normalize_revcomp(spark, sf):
    seq = dna.normalize(F.lower("sequence"), allow_empty=True)
    return views.reads(spark, sf).select("doc_id", F.length(seq).cast("long").alias("n"), F.md5(seq).alias("forward"), F.md5(dna.reverse_complement(seq)).alias("reverse"))


@query("mean_quality_gate", views.with_views("""q AS (SELECT doc_id, length(sequence) AS n, CASE WHEN length(quality) > 0 THEN list_sum(list_transform(string_split(quality, ''), lambda c: ascii(c) - 33)) / length(quality) ELSE 0 END AS mean_q FROM reads)
SELECT doc_id, n::BIGINT AS n, round(mean_q, 6) AS mean_q, CASE WHEN n = 0 THEN 'empty_read' WHEN n < 200 OR n > 20000 THEN 'out_of_length' WHEN mean_q < 12 THEN 'low_quality' ELSE 'pass' END AS gate FROM q""", "reads"))
def mean_quality_gate(spark, sf):
    r = views.reads(spark, sf).withColumn("mean_q", rd.mean_quality(F.col("quality")))
    return r.select("doc_id", F.length("sequence").cast("long").alias("n"), F.round("mean_q", 6).alias("mean_q"), demux.gate(F.length("sequence"), F.col("mean_q"), GATES).alias("gate"))


@query("read_uid_sha256", "SELECT doc_id, sha256(sha256(source) || chr(0) || doc_id) AS read_uid FROM documents")
def read_uid_sha256(spark, sf):
    return views.reads(spark, sf).select("doc_id", rd.stable_uid(F.sha2("well_id", 256), F.col("doc_id")).alias("read_uid"))


KMERS = f"""w AS (SELECT doc_id, plate_id, substr(sequence, i, 15) AS k FROM (SELECT *, unnest(range(1, length(sequence) - 13)) AS i FROM reads WHERE length(sequence) >= 15)),
qk AS (SELECT DISTINCT doc_id, plate_id, least(k, {RC.format('k')}) AS kmer FROM w)"""
INDEX = f"""g AS (SELECT library_id, sequence, string_agg(ref_id, '|' ORDER BY ref_id) AS alias_key FROM refs GROUP BY ALL),
rw AS (SELECT library_id, alias_key, substr(sequence, i, 15) AS k FROM (SELECT *, unnest(range(1, length(sequence) - 13)) AS i FROM g WHERE length(sequence) >= 15)),
rk AS (SELECT DISTINCT library_id, alias_key, least(k, {RC.format('k')}) AS kmer FROM rw),
ix AS (SELECT *, count(*) OVER (PARTITION BY library_id, kmer) AS owners FROM rk)"""
HITS = """r AS (SELECT *, 'lib' || (doc_id % 2) AS library_id FROM qk), c AS (SELECT doc_id, library_id, alias_key, owners, count(*) AS n FROM r JOIN ix USING (library_id, kmer) GROUP BY ALL),
sc AS (SELECT doc_id, library_id, alias_key, sum(n)::BIGINT AS matches, sum(n / owners) AS score FROM c GROUP BY ALL),
top AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, alias_key) AS rank FROM sc)"""


def _queries(spark, sf):
    r = views.spread(views.reads(spark, sf))
    return r.select(F.col("doc_id").alias("read_uid"), F.concat(F.lit("lib"), (F.col("doc_id") % 2).cast("string")).alias("library_id"), F.col("sequence").alias("query"))


@query("canonical_kmers", views.with_views(f"{KMERS} SELECT doc_id, count(*)::BIGINT AS kmers, min(kmer) AS first, max(kmer) AS last FROM qk GROUP BY doc_id", "reads"))
def canonical_kmers(spark, sf):
    sets = kmers.kmer_sets(views.spread(views.reads(spark, sf)), "sequence", 15, ["doc_id"]).where(F.size("kmers") > 0)
    return sets.select("doc_id", F.size("kmers").cast("long").alias("kmers"), kmers.decode(F.array_min("kmers"), 15).alias("first"), kmers.decode(F.array_max("kmers"), 15).alias("last"))


@query("kmer_owner_index", views.with_views(f"{INDEX} SELECT library_id, kmer, alias_key, owners::BIGINT AS owners FROM ix WHERE owners <= 10", "refs"))
def kmer_owner_index(spark, sf):
    ix = kmers.build_index(kmers.alias_groups(views.refs(spark, sf)), 15, 10)
    return ix.select("library_id", kmers.decode(F.col("kmer"), 15).alias("kmer"), "alias_key", "owners")


@query("specificity_shortlist", views.with_views(f"{KMERS}, {INDEX}, {HITS} SELECT doc_id AS read_uid, alias_key, matches, round(score, 6) AS score, rank::BIGINT AS rank FROM top WHERE rank <= 3 AND score >= 2", "reads", "refs"))
def specificity_shortlist(spark, sf):
    ix = kmers.build_index(kmers.alias_groups(views.refs(spark, sf)), 15)
    return kmers.shortlist(_queries(spark, sf), ix, 15, 3, 2.0).select("read_uid", "alias_key", "matches", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@query("alias_groups", views.with_views("SELECT plate_id AS library_id, string_agg(doc_id::VARCHAR, '|' ORDER BY doc_id::VARCHAR) AS alias_key, count(*)::BIGINT AS members FROM reads GROUP BY plate_id, sequence", "reads"))
def alias_groups(spark, sf):
    refs = views.reads(spark, sf).select(F.col("plate_id").alias("library_id"), F.col("doc_id").cast("string").alias("ref_id"), "sequence")
    return kmers.alias_groups(refs).select("library_id", "alias_key", F.size("ref_ids").cast("long").alias("members"))


@query("panel_safety", views.with_views(f"""f AS (SELECT barcode_id, sequence, 'barcode' AS strand FROM nation_panel UNION ALL SELECT barcode_id, {RC.format('sequence')}, 'reverse' FROM nation_panel)
SELECT x.barcode_id AS a, f.barcode_id AS b, f.strand AS strand, levenshtein(x.sequence, f.sequence)::BIGINT AS distance FROM nation_panel x JOIN f ON x.barcode_id < f.barcode_id WHERE levenshtein(x.sequence, f.sequence) < 11""", "nation_panel"))
def panel_safety(spark, sf):
    return demux.unsafe_pairs(views.panel(spark, sf, "nation"), 5, 1).select("a", "b", "strand", *_long("distance"))


@query("barcode_nw_calls", views.with_views("""d AS (SELECT doc_id, barcode_id, levenshtein(substr(tagged.sequence, 1, 24), panel.sequence) AS d FROM tagged, panel),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY d, barcode_id) AS rank, lead(d) OVER (PARTITION BY doc_id ORDER BY d, barcode_id) AS second FROM d)
SELECT doc_id, barcode_id AS best_id, d::BIGINT AS best_edits, second::BIGINT AS second_edits, (second - d)::BIGINT AS margin FROM k WHERE rank = 1""", "tagged"))
def barcode_nw_calls(spark, sf):
    pairs = views.tagged_reads(spark, sf).select("doc_id", F.substring("sequence", 1, 24).alias("head")).crossJoin(F.broadcast(views.panel(spark, sf)))  # five regions
    best = demux.best_and_margin(pairs.withColumn("d", F.levenshtein("head", "sequence")), ["doc_id"], "barcode_id", "d")
    return best.select("doc_id", "best_id", *_long("best_edits", "second_edits", "margin"))


@query("infix_barcode_call", views.with_views(f"""{INFIX}, k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY d, barcode_id) AS rank, lead(d) OVER (PARTITION BY doc_id ORDER BY d, barcode_id) AS second FROM dist)
SELECT doc_id, CASE WHEN d > 4 THEN 'unassigned' WHEN second <= 4 AND second - d < 1 THEN 'ambiguous' ELSE 'assigned' END AS status,
CASE WHEN d <= 4 AND NOT (second <= 4 AND second - d < 1) THEN barcode_id END AS barcode_id FROM k WHERE rank = 1""", "tagged"))
def infix_barcode_call(spark, sf):
    called = demux.call_barcodes(views.spread(views.tagged_reads(spark, sf)).select("doc_id", "sequence"), demux.panel_rows(views.panel(spark, sf)), PLATE, "plate")
    return called.select("doc_id", "plate.status", F.col("plate.id").alias("barcode_id"))


@query("demux_status", views.with_views(f"""{INFIX}, k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY d, barcode_id) AS rank, lead(d) OVER (PARTITION BY doc_id ORDER BY d, barcode_id) AS second FROM dist),
q AS (SELECT doc_id, length(sequence) AS n, list_sum(list_transform(string_split(quality, ''), lambda c: ascii(c) - 33)) / length(quality) AS mean_q FROM tagged)
SELECT doc_id, CASE WHEN n < 200 OR n > 20000 THEN 'out_of_length' WHEN mean_q < 12 THEN 'low_quality' WHEN d > 4 THEN 'plate_unassigned' WHEN second <= 4 AND second - d < 1 THEN 'plate_ambiguous' ELSE 'assigned' END AS call_status,
CASE WHEN NOT (n < 200 OR n > 20000 OR mean_q < 12) AND d <= 4 AND NOT (second <= 4 AND second - d < 1) THEN barcode_id END AS plate FROM k JOIN q USING (doc_id) WHERE rank = 1""", "tagged"))
def demux_status(spark, sf):
    return _demuxed(spark, sf).select("doc_id", "call_status", F.col("plate.id").alias("plate"))


def _demuxed(spark, sf):
    reads = views.spread(views.tagged_reads(spark, sf)).select("doc_id", "sequence", "quality", "well_id")
    return demux.demultiplex(reads, demux.panel_rows(views.panel(spark, sf)), None, PLATE, PLATE, GATES)


@query("demux_export_index", views.with_views("""x AS (SELECT plate_id, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE well_id END AS well_id FROM reads)
SELECT 'by_plate' AS scope, plate_id, NULL::VARCHAR AS well_id, count(*)::BIGINT AS reads FROM x GROUP BY plate_id
UNION ALL SELECT CASE WHEN well_id IS NULL THEN 'unresolved_well' ELSE 'by_well' END, plate_id, well_id, count(*)::BIGINT FROM x GROUP BY ALL""", "reads"))
def demux_export_index(spark, sf):
    r = views.reads(spark, sf)
    return demux.demux_index(r.select(F.struct(F.col("plate_id").alias("id")).alias("plate"), F.struct(F.when(F.col("doc_id") % 4 != 0, F.col("well_id")).alias("id")).alias("well")))


@query("motif_pairs", views.with_views("""l AS (SELECT doc_id, unnest(range(1, length(sequence) - 4)) AS i, sequence FROM reads WHERE length(sequence) >= 6),
a AS (SELECT doc_id, i - 1 AS s, i + 5 AS e FROM l WHERE substr(sequence, i, 6) = 'ACCGTA'), b AS (SELECT doc_id, i - 1 AS s FROM l WHERE substr(sequence, i, 6) = 'GTACCA'),
pr AS (SELECT doc_id, a.s AS ls, a.e AS ie, b.s AS rs, abs(b.s - a.e - 60) AS off FROM a JOIN b USING (doc_id) WHERE b.s - a.e BETWEEN 10 AND 300),
o AS (SELECT pr.*, substr(sequence, ie + 1, rs - ie) AS ins, row_number() OVER (PARTITION BY doc_id ORDER BY off, ls, rs) AS rank, min(off) OVER (PARTITION BY doc_id) AS best FROM pr JOIN reads USING (doc_id)),
n AS (SELECT doc_id, count(DISTINCT ins) FILTER (WHERE off = best) AS rivals FROM o GROUP BY doc_id)
SELECT doc_id, CASE WHEN o.doc_id IS NULL THEN 'motif_missing' WHEN rivals > 1 THEN 'ambiguous' ELSE 'found' END AS status, CASE WHEN rivals = 1 THEN md5(ins) END AS insert_md5
FROM reads LEFT JOIN (SELECT * FROM o WHERE rank = 1) o USING (doc_id) LEFT JOIN n USING (doc_id)""", "reads"))
def motif_pairs(spark, sf):
    pair = motifs.MotifPair("ACCGTA", "GTACCA", 0, False, 10, 300, 60)
    found = motifs.extract_inserts(views.spread(views.reads(spark, sf)).select("doc_id", "sequence"), pair)
    return found.select("doc_id", "extraction.status", F.md5("extraction.insert").alias("insert_md5"))


@query("motif_inserts")
def motif_inserts(spark, sf):
    pair = motifs.MotifPair("ACCGTACG", "GTACCATG", 2, True, 10, 400, 60)
    found = motifs.extract_inserts(views.spread(views.reads(spark, sf)).select("doc_id", "sequence"), pair)
    return found.select("doc_id", "extraction.*")


@query("plate_routing", views.with_views("""SELECT doc_id, library_id, CASE WHEN library_id IS NULL THEN 'unmapped_reference_library' ELSE 'routed' END AS routing
FROM reads LEFT JOIN (VALUES ('en', 'lib0'), ('fr', 'lib1'), ('de', 'lib0')) r(plate_id, library_id) USING (plate_id)""", "reads"))
def plate_routing(spark, sf):
    routes = spark.createDataFrame([("en", "lib0"), ("fr", "lib1"), ("de", "lib0")], "plate_id string, library_id string")
    return assign.route_plates(views.reads(spark, sf), routes, ["lib0", "lib1"]).select("doc_id", "library_id", "routing")


@query("assignment_floor_margin", views.with_views("""d AS (SELECT doc_id, r.sequence AS q, ref_id, f.sequence AS s FROM reads r JOIN refs f ON f.library_id = 'lib' || (doc_id % 2) AND f.block = (doc_id % 5)::VARCHAR WHERE length(r.sequence) > 0),
g AS (SELECT doc_id, ref_id, levenshtein(q, s) AS e, greatest(length(q), length(s)) AS n, length(q) / greatest(length(s), length(q)) AS qc FROM d),
i AS (SELECT *, 1 - e / n AS identity FROM g),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY identity DESC, qc DESC, e, ref_id) AS rank, lead(identity) OVER (PARTITION BY doc_id ORDER BY identity DESC, qc DESC, e, ref_id) AS second FROM i)
SELECT doc_id, ref_id, round(identity, 6) AS identity, CASE WHEN identity < 0.42 THEN 'no_match' WHEN second >= 0.42 AND identity - second < 0.02 THEN 'ambiguous' ELSE 'assigned_unique' END AS status FROM k WHERE rank = 1""", "reads", "refs"))
def assignment_floor_margin(spark, sf):
    r = views.spread(views.reads(spark, sf)).where(F.length("sequence") > 0).select("doc_id", F.col("sequence").alias("q"), F.concat(F.lit("lib"), (F.col("doc_id") % 2).cast("string")).alias("library_id"), (F.col("doc_id") % 5).cast("string").alias("block"))
    f = views.refs(spark, sf).select("library_id", "block", F.col("ref_id").alias("alias_key"), F.col("sequence").alias("s"))
    near = distances.distances_to(r.withColumn("n", F.length("q")), f.withColumn("m", F.length("s")), ["library_id", "block"], "q", "s")
    longest = F.greatest("n", "m")
    pairs = near.select("doc_id", "alias_key", "edit_distance", (1 - F.col("edit_distance") / longest).alias("identity"), (F.col("n") / longest).alias("query_coverage"), F.lit(1.0).alias("reference_coverage"), F.lit(0.0).alias("score"))
    told = assign.decide(pairs, assign.AssignSettings(min_identity=0.42, min_query_coverage=0.0, min_reference_coverage=0.0), "doc_id")
    return told.select("doc_id", F.col("alias_key").alias("ref_id"), F.round("identity", 6).alias("identity"), F.col("assignment_status").alias("status"))


@query("assignment_cascade")
def assignment_cascade(spark, sf):
    s = assign.AssignSettings(kmer_sizes=(15, 11), max_kmer_owners=10, min_identity=0.6, min_query_coverage=0.0, min_reference_coverage=0.5, rescue="none")
    return assign.assign_reads(_queries(spark, sf), kmers.alias_groups(views.refs(spark, sf)), s)


@query("claimed_anti", views.with_views("SELECT r.doc_id, plate_id FROM reads r ANTI JOIN (SELECT DISTINCT doc_id FROM labels WHERE quality = 0) c USING (doc_id)", "reads"))
def claimed_anti(spark, sf):
    claimed = views.table(spark, sf, "labels").where("quality = 0").select("doc_id").distinct()
    return views.reads(spark, sf).join(claimed, "doc_id", "left_anti").select("doc_id", "plate_id")


@query("translate_codons", views.with_views("""c AS (SELECT doc_id, sequence, list_transform(range(0, length(sequence) // 3), lambda i: substr(sequence, 3 * i + 1, 3)) AS cs FROM reads),
m AS (SELECT doc_id, list_transform(cs, lambda c: substr('FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG', (16 * (strpos('TCAG', substr(c, 1, 1)) - 1) + 4 * (strpos('TCAG', substr(c, 2, 1)) - 1) + strpos('TCAG', substr(c, 3, 1)))::INT, 1)) AS aa FROM c),
p AS (SELECT doc_id, array_to_string(aa, '') AS protein FROM m)
SELECT doc_id, length(protein)::BIGINT AS residues, md5(protein) AS protein_md5, (strpos(left(protein, length(protein) - 1), '*') - 1)::BIGINT AS internal_stop FROM p""", "reads"))
def translate_codons(spark, sf):
    p = views.reads(spark, sf).select("doc_id", protein.translate(F.col("sequence")).alias("p"))
    return p.select("doc_id", F.length("p").cast("long").alias("residues"), F.md5("p").alias("protein_md5"), F.coalesce(protein.first_internal_stop(F.col("p")), F.lit(-1)).cast("long").alias("internal_stop"))


@query("orf_frame", views.with_views("""i AS (SELECT doc_id, sequence, unnest(range(0, length(sequence) - 5)) AS b FROM reads WHERE length(sequence) >= 6),
a AS (SELECT doc_id, b FROM i WHERE substr(sequence, b + 1, 3) = 'ATG'), t AS (SELECT doc_id, b FROM (SELECT doc_id, sequence, unnest(range(0, length(sequence) - 2)) AS b FROM reads WHERE length(sequence) >= 3) WHERE substr(sequence, b + 1, 3) IN ('TAA', 'TAG', 'TGA')),
o AS (SELECT a.doc_id, a.b AS s, min(t.b) + 3 AS e FROM a JOIN t ON a.doc_id = t.doc_id AND t.b >= a.b + 3 AND (t.b - a.b) % 3 = 0 GROUP BY ALL)
SELECT doc_id, arg_min(s, s)::BIGINT AS start, arg_min(e, s)::BIGINT AS "end" FROM o GROUP BY doc_id""", "reads"))
def orf_frame(spark, sf):
    r = views.spread(views.reads(spark, sf)).select("doc_id", protein.first_orf(F.col("sequence")).alias("o"))
    return r.where("o is not null").select("doc_id", F.col("o.start").cast("long").alias("start"), F.col("o.end").cast("long").alias("end"))


@query("homopolymer_gc", views.with_views("""SELECT doc_id, round(CASE WHEN length(sequence) > 0 THEN 100.0 * (length(sequence) - length(replace(replace(sequence, 'G', ''), 'C', ''))) / length(sequence) ELSE 0 END, 6) AS gc,
greatest(coalesce(list_max(list_transform(regexp_extract_all(sequence, 'A+|C+|G+|T+'), lambda x: length(x))), 0), 0)::BIGINT AS longest,
coalesce(list_max(list_transform(regexp_extract_all(sequence, 'G+'), lambda x: length(x))), 0)::BIGINT AS longest_g FROM reads""", "reads"))
def homopolymer_gc(spark, sf):
    s = F.col("sequence")
    return views.reads(spark, sf).select("doc_id", F.round(dna.gc_percent(s), 6).alias("gc"), dna.longest_run(s).cast("long").alias("longest"), dna.longest_run(s, "G").cast("long").alias("longest_g"))


@query("sequence_context", views.with_views("""p AS (SELECT doc_id, sequence, (length(sequence) // 2)::INT AS i FROM reads WHERE length(sequence) > 0), c AS (SELECT *, substr(sequence, greatest(i - 10, 0) + 1, i + 11 - greatest(i - 10, 0)) AS ctx FROM p)
SELECT doc_id, i::BIGINT AS i, ctx, CASE WHEN contains(ctx, 'GATC') THEN 'dam' WHEN regexp_matches(ctx, 'CC[AT]GG') THEN 'dcm' ELSE 'none' END AS motif FROM c""", "reads"))
def sequence_context(spark, sf):
    r = views.reads(spark, sf).where(F.length("sequence") > 0).withColumn("i", F.floor(F.length("sequence") / 2).cast("int"))
    told = r.withColumn("ctx", dna.context(F.col("sequence"), F.col("i")))
    return told.select("doc_id", *_long("i"), "ctx", dna.methylation_motif(F.col("ctx")).alias("motif"))


@query("bsai_excision", views.with_views("""i AS (SELECT doc_id, sequence, unnest(range(0, length(sequence) - 3)) AS b FROM reads WHERE length(sequence) >= 4),
l AS (SELECT doc_id, b FROM i WHERE substr(sequence, b + 1, 4) = 'ACGT'), r AS (SELECT doc_id, b FROM i WHERE substr(sequence, b + 1, 4) = 'TGCA')
SELECT l.doc_id, count(*)::BIGINT AS bodies, min(r.b - 1 - (l.b + 5))::BIGINT AS shortest FROM l JOIN r ON l.doc_id = r.doc_id AND r.b - 1 - (l.b + 5) >= 8 GROUP BY l.doc_id""", "reads"))
def bsai_excision(spark, sf):
    found = views.spread(views.reads(spark, sf)).select("doc_id", dna.excision_sizes(F.col("sequence"), "ACGT", "TGCA").alias("n"))
    return found.where("n.bodies > 0").select("doc_id", "n.bodies", "n.shortest")


@query("overhang_variants", views.with_views("""x AS (SELECT plate_id AS block, doc_id::VARCHAR AS gene_id, sequence, substr(sequence, 1, 4) AS o5, right(sequence, 4) AS o3 FROM reads)
SELECT block, o5 AS overhang_5, o3 AS overhang_3, count(DISTINCT gene_id)::BIGINT AS genes, count(DISTINCT sequence)::BIGINT AS variants FROM x GROUP BY ALL HAVING count(DISTINCT gene_id) > 1""", "reads"))
def overhang_variants(spark, sf):
    pieces = views.reads(spark, sf).select(F.col("plate_id").alias("block"), F.col("doc_id").cast("string").alias("gene_id"), "sequence")
    return fragments.interchangeable(pieces)


@query("iupac_pairs", """WITH s AS (SELECT regexp_replace(upper(p_name || p_type), '[^ACGTRYSWKMBDHVN]', '', 'g') AS s FROM part),
p AS (SELECT substr(s, i, 1) AS a, substr(s, i + 1, 1) AS b FROM (SELECT s, unnest(range(1, length(s))) AS i FROM s)),
m AS (SELECT *, [1, 2, 4, 8, 5, 10, 6, 9, 12, 3, 14, 13, 11, 7, 15] AS mask FROM p)
SELECT a, b, count(*)::BIGINT AS n, (any_value(mask[strpos('ACGTRYSWKMBDHVN', a)]) & any_value(mask[strpos('ACGTRYSWKMBDHVN', b)])) <> 0 AS compatible FROM m GROUP BY a, b""")
def iupac_pairs(spark, sf):
    """Neighbouring symbols of all names, and whether they share a base."""
    own = views.table(spark, sf, "part").select(F.regexp_replace(F.upper(F.concat("p_name", "p_type")), f"[^{dna.IUPAC}]", "").alias("s")).where(F.length("s") > 1)
    both = F.transform(F.sequence(F.lit(1), F.length("s") - 1), lambda i: F.struct(F.substring("s", i, F.lit(1)).alias("a"), F.substring("s", i + 1, F.lit(1)).alias("b")))
    counted = own.select(F.explode(both).alias("p")).groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("a", "b", "n", dna.symbols_compatible(F.col("a"), F.col("b")).alias("compatible"))


@query("safe_names", """WITH n AS (SELECT p_partkey, p_name || ' ' || p_type || '/#' || repeat('x', (p_partkey % 40)::INT) AS v FROM part), c AS (SELECT *, regexp_replace(regexp_replace(v, '[^A-Za-z0-9._-]+', '_', 'g'), '^[._-]+|[._-]+$', '', 'g') AS t FROM n)
SELECT p_partkey, CASE WHEN length(t) > 56 THEN left(t, 47) || '~' || left(sha256(v), 8) ELSE t END AS name FROM c""")
def safe_names(spark, sf):
    p = views.table(spark, sf, "part")
    return p.select("p_partkey", rd.safe_name(F.concat("p_name", F.lit(" "), "p_type", F.lit("/#"), F.repeat(F.lit("x"), (F.col("p_partkey") % 40).cast("int")))).alias("name"))


@query("name_parts", """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE chr((65 + c_custkey % 2)::INT) END AS encoding, CASE WHEN c_custkey % 3 = 0 THEN -1 ELSE (c_custkey % 12)::BIGINT END AS block, (c_custkey % 12)::VARCHAR AS named_block,
chr((65 + c_custkey % 8)::INT) || lpad((c_custkey % 12 + 1)::VARCHAR, 2, '0') AS well FROM customer""")
def name_parts(spark, sf):
    c = views.table(spark, sf, "customer")
    k = F.col("c_custkey")
    number = (k % 12).cast("string")
    name = F.concat(F.char((65 + k % 2).cast("int")), F.lit("_Block_"), number, F.lit("_x"))
    parts = rd.reference_parts(F.when(k % 3 == 0, F.lit("odd")).otherwise(name))
    well = rd.normalized_well(F.concat(F.char((97 + k % 8).cast("int")), (k % 12 + 1).cast("string")))
    return c.select("c_custkey", parts["encoding"].alias("encoding"), F.coalesce(parts["block"], F.lit(-1)).cast("long").alias("block"), rd.block_of(F.concat(F.lit("Block_"), number, F.lit("_x"))).alias("named_block"), well.alias("well"))


@query("prefix_sample", "SELECT doc_id, source FROM documents WHERE doc_id < 250")
def prefix_sample(spark, sf):
    from ..sources.fastq import first_records

    d = views.table(spark, sf, "documents")
    return first_records(d.withColumn("record_index", F.col("doc_id")), 250).select("doc_id", "source")


@query("reference_digest", views.with_views("SELECT ref_id, sha256(sequence) AS sequence_sha256, length(sequence)::BIGINT AS n, rtrim(regexp_replace(sequence, '(.{80})', '\\1' || chr(10), 'g'), chr(10)) AS wrapped FROM refs", "refs"))
def reference_digest(spark, sf):
    return views.refs(spark, sf).select("ref_id", F.sha2("sequence", 256).alias("sequence_sha256"), F.length("sequence").cast("long").alias("n"), dna.wrapped(F.col("sequence")).alias("wrapped"))


@query("reference_block_lookup", views.with_views("SELECT ref_id, CASE WHEN length(sequence) % 2 = 0 THEN 'D' || block ELSE block END AS block FROM refs", "refs"))
def reference_block_lookup(spark, sf):
    r = views.refs(spark, sf)
    designs = r.where(F.length("sequence") % 2 == 0).select("sequence", F.concat(F.lit("D"), "block").alias("block"))
    return pooling.reference_blocks(r.drop("block"), designs, r"^Block_(\d+)_").select("ref_id", "block")


@query("trimmed_barcodes", views.with_views("SELECT barcode_id, substr(sequence, 4, 18) AS trimmed FROM nation_panel", "nation_panel"))
def trimmed_barcodes(spark, sf):
    return views.panel(spark, sf, "nation").select("barcode_id", dna.trim_both(F.col("sequence"), 3).alias("trimmed"))


@query("spliced_scaffolds", views.with_views("""p AS (SELECT sequence, row_number() OVER (ORDER BY ref_id) AS k FROM refs)
SELECT a.k::BIGINT AS k, substr(a.sequence, 1, (a.k % 4 * 45)::INT) || substr(b.sequence, (least(a.k % 4 * 45, length(b.sequence)) + 1)::INT) AS scaffold FROM p a JOIN p b ON b.k = a.k + 1""", "refs"))
def spliced_scaffolds(spark, sf):
    p = numbered(views.refs(spark, sf), ["ref_id"], "k")
    b = p.select((F.col("k") - 1).alias("k"), F.col("sequence").alias("right"))
    return p.join(b, "k").select(*_long("k"), dna.spliced(F.col("sequence"), F.col("right"), (F.col("k") % 4).cast("int"), F.lit(45)).alias("scaffold"))


@query("median_index_style", views.with_views("SELECT plate_id, list_sort(list(length(sequence)))[count(*) // 2 + 1]::BIGINT AS upper_median, median(length(sequence))::DOUBLE AS median FROM reads GROUP BY plate_id", "reads"))
def median_index_style(spark, sf):
    """Element n // 2 of the sorted lengths, by counts of each length: a plate is as many rows as it has lengths."""
    counted = views.reads(spark, sf).groupBy("plate_id", F.length("sequence").alias("n")).agg(F.count(F.lit(1)).alias("reads"))
    upto = F.sum("reads").over(Window.partitionBy("plate_id").orderBy("n"))
    told = counted.withColumns({"upto": upto, "half": F.floor(F.sum("reads").over(Window.partitionBy("plate_id")) / 2)})
    return told.groupBy("plate_id").agg(F.min(F.when(F.col("upto") > F.col("half"), F.col("n"))).cast("long").alias("upper_median"), F.percentile("n", 0.5, F.col("reads")).alias("median"))
