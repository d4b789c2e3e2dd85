"""Alignment features, templates and clustering on the business tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.operators import cluster, msa, seqcluster, sequences, templates
from helixframe.plans.base import Tables, query
from helixframe.session import materialize

ROW_SQL = """SELECT p_partkey, p_brand, regexp_replace(upper(p_name), '[^A-Z]', '-', 'g') AS a, lower(substr(p_type, 1, 1 + CAST(p_partkey % 3 AS INT))) AS ins FROM part"""


def rows(t: Tables):
    """Alignment rows: the part's name in capitals with an insertion before its second letter and a trailing one."""
    a = F.regexp_replace(F.upper("p_name"), "[^A-Z]", "-")
    ins = F.lower(F.substr("p_type", F.lit(1), (F.col("p_partkey") % 3 + 1).cast("int")))
    row = F.concat(F.substring(a, 1, 1), ins, F.substr(a, F.lit(2)), F.lit("xx"))
    return t.part.select("p_partkey", "p_brand", row.alias("row"), F.concat_ws("/", "p_brand", F.length(a)).alias("msa"))


@query(f"""SELECT p_partkey, a AS aligned, length(ins) AS deletions_before_second FROM ({ROW_SQL})""")
def msa_deletions(t: Tables):
    return rows(t).select("p_partkey", msa.aligned(F.col("row")).alias("aligned"), F.element_at(msa.deletions(F.col("row")), 2).cast("long").alias("deletions_before_second"))


INDEX_SQL = """CASE WHEN ch = '-' THEN 31 WHEN strpos('ARNDCQEGHILKMFPSTWYV', ch) > 0 THEN strpos('ARNDCQEGHILKMFPSTWYV', ch) - 1
WHEN ch = 'B' THEN 3 WHEN ch = 'U' THEN 4 WHEN ch = 'Z' THEN 6 ELSE 20 END"""
CELLS_SQL = f"""SELECT p_partkey, p_brand || '/' || length(a) AS msa, pos, CAST({INDEX_SQL} AS INT) AS idx, CASE WHEN pos = 1 THEN length(ins) ELSE 0 END AS deletion FROM (
SELECT *, substr(a, CAST(pos + 1 AS BIGINT), 1) AS ch FROM (SELECT *, unnest(range(length(a))) AS pos FROM ({ROW_SQL})))"""


@query(f"""SELECT p_partkey, string_agg(CAST(idx AS VARCHAR), ',' ORDER BY pos) AS codes FROM ({CELLS_SQL}) GROUP BY 1""")
def msa_encode(t: Tables):
    return rows(t).select("p_partkey", F.array_join(msa.encode(F.col("row")), ",").alias("codes"))


@query(f"""WITH c AS ({CELLS_SQL}) SELECT msa, pos, idx, round(n / depth, 6) AS frequency, round(d, 6) AS deletion_mean FROM (
SELECT msa, pos, idx, count(*) AS n FROM c GROUP BY 1, 2, 3) JOIN (SELECT msa, pos, count(*) AS depth, avg(atan(deletion / 3) * 2 / pi()) AS d FROM c GROUP BY 1, 2) USING (msa, pos)""")
def msa_profile(t: Tables):
    out = msa.profile_rows(msa.profile_matrices(rows(t), "msa", "row"))
    return out.select("msa", "pos", F.col("idx").cast("int").alias("idx"), F.round("frequency", 6).alias("frequency"), F.round("deletion_mean", 6).alias("deletion_mean"))


@query(f"""WITH c AS ({CELLS_SQL}) SELECT p_partkey, msa, count(*) AS n_positions, round(sum(f), 4) AS own_frequency FROM c JOIN (
SELECT msa, pos, idx, n / sum(n) OVER (PARTITION BY msa, pos) AS f FROM (SELECT msa, pos, idx, count(*) AS n FROM c GROUP BY 1, 2, 3)) USING (msa, pos, idx) GROUP BY 1, 2""")
def msa_tables(t: Tables):
    """Row side and profile side of an alignment, joined by position."""
    base = rows(t)
    dense = msa.dense_profile(msa.profile_counts(msa.positions(base, "msa", "row")))
    cells = base.select("p_partkey", "msa", F.posexplode(msa.encode(F.col("row"))).alias("pos", "idx"))
    # a row a letter: small as a file, but not to be broadcast
    joined = cells.hint("merge").join(dense, ["msa", "pos"]).select("p_partkey", "msa", F.element_at("profile", F.col("idx") + 1).cast("double").alias("f"))
    return joined.groupBy("p_partkey", "msa").agg(F.count(F.lit(1)).alias("n_positions"), F.round(F.sum("f"), 4).alias("own_frequency"))


@query("""SELECT s_suppkey, CASE WHEN s_suppkey = 0 THEN 'query' WHEN s_suppkey % 3 = 0 THEN 'uniref100' WHEN s_suppkey % 3 = 1 THEN 'tr' ELSE 'bfd' END AS database,
CASE WHEN s_suppkey = 0 THEN 'query' WHEN s_suppkey % 3 = 2 THEN s_name ELSE 'W' || s_suppkey END AS database_id,
CASE WHEN s_suppkey = 0 THEN 'query' WHEN s_suppkey % 3 = 2 THEN 'N/A' ELSE 'Genus species ' || s_nationkey END AS species,
CASE WHEN s_suppkey = 0 THEN 'query' WHEN s_suppkey % 3 = 0 THEN 'W' || s_suppkey || '_X' WHEN s_suppkey % 3 = 1 THEN s_name ELSE s_name END AS rep_id FROM supplier""")
def msa_headers(t: Tables):
    tax, key = F.concat(F.lit("Genus species "), "s_nationkey"), F.concat(F.lit("W"), "s_suppkey")
    header = (
        F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit(">UniRef100_"), key, F.lit(" some protein n=1 Tax="), tax, F.lit(" TaxID=7 RepID="), key, F.lit("_X")))
        .when(F.col("s_suppkey") % 3 == 1, F.concat(F.lit("tr|"), key, F.lit("|"), "s_name", F.lit(" some protein OS="), tax, F.lit(" OX=9 PE=4")))
        .otherwise(F.concat("s_name", F.lit(" tail"))))
    out = msa.header_fields(t.supplier.withColumn("header", header), "header", "s_suppkey")
    return out.select("s_suppkey", "database", "database_id", "species", "rep_id")


@query(f"""SELECT p_partkey, p_brand FROM (SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY
(length(a) - length(replace(a, '-', ''))) / greatest(length(a), 1), p_partkey) AS r FROM ({ROW_SQL})) WHERE r <= 20""")
def msa_depth_cap(t: Tables):
    return msa.cap_depth(rows(t), "p_brand", "row", "p_partkey", 20).select("p_partkey", "p_brand")


@query(f"""WITH RECURSIVE s AS (SELECT p_partkey, a, p_brand || '/' || length(a) AS msa, row_number() OVER (PARTITION BY p_brand, length(a) ORDER BY p_partkey) AS i FROM ({ROW_SQL})
WHERE 1 - (length(a) - length(replace(a, '-', ''))) / greatest(length(a), 1) >= 0.5),
w AS (SELECT DISTINCT msa, CAST(0 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS kept, CAST(NULL AS BIGINT) AS p_partkey FROM s
UNION ALL SELECT msa, i, CASE WHEN fresh THEN list_append(kept, a) ELSE kept END, CASE WHEN fresh THEN p_partkey END FROM (
SELECT s.msa, s.i, s.a, s.p_partkey, w.kept, len(list_filter(w.kept, lambda k: len(list_filter(range(1, length(s.a) + 1), lambda j: k[j] = s.a[j] AND k[j] <> '-'))
> CAST(0.9 AS DOUBLE) * greatest(len(list_filter(range(1, length(s.a) + 1), lambda j: k[j] <> '-' AND s.a[j] <> '-')), 1))) = 0 AS fresh FROM w JOIN s ON s.msa = w.msa AND s.i = w.i + 1))
SELECT p_partkey, msa FROM w WHERE p_partkey IS NOT NULL""")
def msa_redundancy(t: Tables):
    kept = msa.drop_redundant(rows(t).select("p_partkey", "msa", "row"), "msa", "row", "p_partkey", 0.5)
    return kept.select("p_partkey", "msa")


@query("""WITH c AS (SELECT p_brand, p_size % 3 AS tier, count_if(p_size >= 10) AS n75, count(*) AS n50 FROM part GROUP BY 1, 2),
m AS (SELECT *, CASE WHEN n75 > 22 THEN 'cov75' WHEN n50 > 27 THEN 'cov50' END AS ch FROM c)
SELECT p_brand, coalesce(min(tier) FILTER (ch IS NOT NULL), max(tier)) AS tier, coalesce(min_by(ch, tier) FILTER (ch IS NOT NULL), 'fallback') AS choice FROM m GROUP BY 1""")
def msa_tiers(t: Tables):
    counts = t.part.groupBy("p_brand", (F.col("p_size") % 3).alias("tier")).agg(F.count_if(F.col("p_size") >= 10).alias("n75"), F.count(F.lit(1)).alias("n50"))
    return msa.choose_tier(counts, "p_brand", "tier", "n75", "n50", 22, 27)


@query("""SELECT doc_id, CASE WHEN k = 'P' AND text IN (SELECT text FROM documents WHERE source = 'src1') THEN 'antibody_H'
WHEN k = 'P' AND text IN (SELECT text FROM documents WHERE source = 'src2') THEN 'antibody_L'
WHEN k = 'P' AND length(text) < 400 THEN 'peptide' WHEN k = 'P' THEN 'protein' WHEN k = 'Q' THEN 'protein_D' WHEN k IN ('N', 'R', 'D') THEN 'nucleotide' ELSE 'ligand' END AS route
FROM (SELECT doc_id, text, CASE lang WHEN 'en' THEN 'P' WHEN 'fr' THEN 'Q' WHEN 'de' THEN 'D' ELSE 'L' END AS k FROM documents)""")
def sequence_routing(t: Tables):
    docs = t.documents.select("doc_id", F.col("text").alias("sequence"), "source",
                              F.when(F.col("lang") == "en", "P").when(F.col("lang") == "fr", "Q").when(F.col("lang") == "de", "D").otherwise("L").alias("mol_type"))
    return cluster.route_sequences(docs, docs.where("source = 'src1'"), docs.where("source = 'src2'"), shortest=400).select("doc_id", "route")


@query("""SELECT p_partkey, string_agg(ch, '' ORDER BY k) AS sequence FROM (
SELECT p_partkey, k, substr(p_name, CAST(k AS BIGINT), 1) AS ch FROM (SELECT p_partkey, p_name, unnest(range(1, length(p_name) + 1)) AS k FROM part)) WHERE k BETWEEN 2 AND 5 GROUP BY 1
UNION ALL SELECT p_partkey, NULL FROM part WHERE length(p_name) < 2""")
def range_extract(t: Tables):
    numbered = t.part.select("p_partkey", F.posexplode(F.split("p_name", "")).alias("number", "residue")).where("residue <> ''").withColumn("number", F.col("number") + 1)
    regions = t.region.select(F.lit("R1").alias("region"), F.lit(2).alias("first"), F.lit(5).alias("last")).distinct()
    found, failed = cluster.extract_ranges(numbered, regions, "p_partkey", "number", "residue")
    return found.select("p_partkey", "sequence").unionByName(failed.withColumn("sequence", F.lit(None).cast("string")))


@query("""WITH w AS (SELECT doc_id, string_split(trim(regexp_replace(text, '[ \\n]+', ' ', 'g')), ' ') AS t FROM (SELECT min(doc_id) AS doc_id, text FROM documents GROUP BY text)),
s AS (SELECT DISTINCT doc_id, array_to_string(t[i:i + 7], ' ') AS g FROM (SELECT doc_id, t, unnest(range(1, len(t) - 6)) AS i FROM w WHERE len(t) >= 8))
SELECT a.doc_id AS id1, b.doc_id AS id2, count(*) AS n FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2""")
def similar_candidates(t: Tables):
    """Pairs of different texts; copies of a text are its first document."""
    firsts = t.documents.groupBy("text").agg(F.min("doc_id").alias("doc_id"))
    return cluster.shared_shingles(firsts, "doc_id", "text", 8)


@query("""WITH w AS (SELECT doc_id, string_split(trim(regexp_replace(text, '[ \\n]+', ' ', 'g')), ' ') AS t FROM (SELECT min(doc_id) AS doc_id, text FROM documents GROUP BY text)),
s AS (SELECT DISTINCT doc_id, array_to_string(t[i:i + 7], ' ') AS g FROM (SELECT doc_id, t, unnest(range(1, len(t) - 6)) AS i FROM w WHERE len(t) >= 8)),
f AS (SELECT g, min(doc_id) AS first FROM s GROUP BY g)
SELECT s.doc_id AS id, f.first, count(*) AS n FROM s JOIN f ON s.g = f.g WHERE s.doc_id > f.first GROUP BY 1, 2""")
def shingle_links(t: Tables):
    """Each different text's links to the first texts of its word runs."""
    firsts = t.documents.groupBy("text").agg(F.min("doc_id").alias("doc_id"))
    return cluster.shingle_links(firsts, "doc_id", "text", 8)


def names(t: Tables):
    """Short sequences: customers' segments with their nation and balance spelled out."""
    return t.customer.select(F.col("c_custkey").alias("id"), F.concat("c_mktsegment", F.col("c_nationkey").cast("string"), F.round("c_acctbal", 0).cast("string")).alias("sequence"))


@query()
def similar_clusters(t: Tables):
    """Customers' names by links to centres."""
    copies = materialize(cluster.first_copies(names(t), "id", "sequence"), "copies")
    seqs = copies.where("id = first").select("id", "sequence")
    links = materialize(seqcluster.linked_centres(seqs, "id", "sequence", 0.8, 0.8, k=6, window=1, band=4), "links")
    return cluster.with_copies(cluster.cluster_components(seqs, "id", links), copies, "id")


@query()
def greedy_representatives(t: Tables):
    copies = materialize(cluster.first_copies(names(t), "id", "sequence"), "copies")
    seqs = copies.where("id = first").select("id", "sequence")
    return cluster.with_copies(seqcluster.greedy_bands(seqs, "id", "sequence", 0.9, 0.8, k=4), copies, "id")


def letters(t: Tables):
    """Documents' letters as sequences, the first of equal ones."""
    plain = t.documents.select("doc_id", F.regexp_replace(F.translate("text", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "[^A-Z]", "").alias("sequence")).where("sequence <> ''")
    return plain.groupBy("sequence").agg(F.min("doc_id").alias("doc_id"))


@query("""WITH s AS (SELECT min(doc_id) AS id, sequence FROM (SELECT doc_id, regexp_replace(translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'), '[^A-Z]', '', 'g') AS sequence FROM documents) WHERE sequence <> '' GROUP BY sequence),
k AS (SELECT id, length(sequence) AS n, i - 1 AS place, substr(sequence, i, 10) AS w FROM (SELECT id, sequence, unnest(range(1, length(sequence) - 8)) AS i FROM s WHERE length(sequence) >= 10)),
d AS (SELECT DISTINCT w FROM k),
c AS (SELECT w, CAST(list_reduce(list_transform(string_split(w, ''), lambda x: CAST(unicode(x) & 63 AS HUGEINT)), lambda a, b: a * 64 + b) AS BIGINT) AS word FROM d),
r AS (SELECT id, n, place, word, CAST(word % 2147483647 AS HUGEINT) * 48271 % 2147483647 AS rank FROM k JOIN c USING (w)),
o AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY rank, word, place) AS o FROM r),
m AS (SELECT *, min(o) OVER (PARTITION BY id ORDER BY place ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS low FROM o),
mins AS (SELECT DISTINCT id, low FROM m WHERE place >= least(29, n - 10)),
picked AS (SELECT o.id, o.n, o.word, min(o.place) AS place FROM o JOIN mins ON mins.id = o.id AND mins.low = o.o GROUP BY 1, 2, 3),
longest AS (SELECT word, max(n) AS n FROM picked GROUP BY word HAVING count(*) > 1),
centres AS (SELECT word, min(p.id) AS centre, any_value(p.n) AS most FROM picked p JOIN longest USING (word, n) GROUP BY word),
placed AS (SELECT c.*, p.place AS there FROM centres c JOIN picked p ON p.word = c.word AND p.id = c.centre),
votes AS (SELECT p.id, centre, p.place - there AS diagonal, count(*) AS votes FROM picked p JOIN placed USING (word) WHERE p.id <> centre AND p.n >= 0.8 * most GROUP BY ALL)
SELECT id, centre, CAST(list(diagonal ORDER BY votes DESC, abs(diagonal), diagonal DESC)[1] AS BIGINT) AS diagonal, CAST(sum(votes) AS BIGINT) AS votes FROM votes GROUP BY id, centre HAVING sum(votes) >= 3""")
def kmer_centres(t: Tables):
    """Whole documents as sequences: members, centres and diagonals of their minimisers."""
    words = materialize(seqcluster.minimisers(letters(t), "doc_id", "sequence", 10, 30), "minimisers")
    return seqcluster.centre_pairs(words, 0.8, 3)


@query()
def sequence_families(t: Tables):
    """Whole documents as sequences, clustered by links to centres."""
    seqs = materialize(letters(t), "letters")
    links = materialize(seqcluster.linked_centres(seqs, "doc_id", "sequence", 0.8, 0.8, 10, 30, 3), "links")
    return cluster.cluster_components(seqs, "doc_id", links)


@query("""WITH c AS (SELECT doc_id AS id, 's' || max(quality) || max(toxic) AS rep FROM labels GROUP BY 1)
SELECT doc_id AS id, coalesce(rep, 'p' || doc_id) AS representative,
CASE WHEN rep IS NULL AND n_chars < 600 THEN 'protein' ELSE source END AS route FROM documents LEFT JOIN c ON c.id = doc_id""")
def cluster_assembly(t: Tables):
    """Labelled documents are clustered by their labels, the others stand alone."""
    found = t.labels.groupBy(F.col("doc_id").alias("id")).agg(F.concat(F.lit("s"), F.max("quality"), F.max("toxic")).alias("representative"))
    ids = t.documents.select(F.col("doc_id").alias("id"), "n_chars", F.col("source").alias("route"))
    alone = cluster.with_singletons(found.withColumn("id", F.col("id").cast("string")), ids.select(F.col("id").cast("string").alias("id")), "id", "representative")
    failed = ids.where("n_chars < 600").join(found, "id", "left_anti")
    routed = cluster.reroute(ids, failed, "id", "route", "protein").withColumn("id", F.col("id").cast("string"))
    merged = cluster.merge_clusterings([found.withColumn("id", F.col("id").cast("string")), alone], "id", "representative")
    out = merged.join(routed.select("id", "route"), "id")
    return out.select(F.col("id").cast("long").alias("id"), F.when(F.col("id") == F.col("representative"), F.concat(F.lit("p"), "id")).otherwise(F.col("representative")).alias("representative"), "route")


@query("""WITH f AS (SELECT user_id, min(ts) AS first FROM events GROUP BY 1)
SELECT event_id, user_id FROM (SELECT event_id, e.user_id, row_number() OVER (PARTITION BY e.user_id ORDER BY event_id) AS r FROM events e JOIN f USING (user_id)
WHERE date_diff('day', CAST(first AS DATE), CAST(ts AS DATE)) >= 2 AND value >= 10) WHERE r <= 20""")
def template_topk(t: Tables):
    first = sequences.earliest(t.events, "user_id", "ts", "first")
    hits = t.events.join(first, "user_id")
    return templates.candidate_hits(hits, "user_id", "event_id", "ts", "first", length="value", cutoff=None, gap_days=2, shortest=10).select("event_id", "user_id")


@query()
def align_project(t: Tables):
    """Part names of one size aligned pairwise with the size's first name and projected onto it."""
    heads = sequences.first_per_key(t.part.select("p_size", "p_name", "p_partkey"), ["p_size"], ["p_partkey"]).select("p_size", F.col("p_name").alias("q"))
    pairs = t.part.select("p_size", "p_partkey", F.col("p_name").alias("t")).join(heads, "p_size")
    done = cluster.align_pairs(pairs, "q", "t", ["p_partkey", "p_size"])
    columns = templates.alignment_columns(done, ["p_partkey"])
    target = t.part.select("p_partkey", F.posexplode(F.split("p_name", "")).alias("t_pos", "letter")).where("letter <> ''").withColumn("t_pos", F.col("t_pos").cast("long"))
    queries = pairs.select("p_partkey", F.length("q").cast("long").alias("n"))
    out = templates.project(columns, target, ["p_partkey"], queries, "n", {"letter": "."})
    return sequences.ordered_join(out, ["p_partkey"], ["q_pos"], "letter", "projected")


@query("""SELECT user_id, n, ca, c, coalesce(CASE WHEN has THEN cb END, CASE WHEN NOT has THEN ca END) AS cb FROM (
SELECT user_id, max(CASE WHEN event_type = 'view' THEN value END) AS n, max(CASE WHEN event_type = 'click' THEN value END) AS ca,
max(CASE WHEN event_type = 'error' THEN value END) AS c, max(CASE WHEN event_type = 'signup' AND value > 50 THEN value END) AS cb,
bool_or(event_type = 'signup' AND value > 50) AS has FROM events GROUP BY 1)""")
def backbone_pivot(t: Tables):
    atoms = t.events.where("event_type <> 'signup' or value > 50")
    out = templates.backbone(atoms, ["user_id"], "event_type", "value", ["view", "click", "error", "signup"])
    every = t.events.select("user_id").distinct().join(out, "user_id", "left")
    return every.select("user_id", F.col("view").alias("n"), F.col("click").alias("ca"), F.col("error").alias("c"), F.col("signup").alias("cb"))


@query("""SELECT o_custkey, o_orderkey, q AS weight FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY q DESC, o_orderkey) AS r FROM (
SELECT o_custkey, o_orderkey, sum(l_quantity) AS q FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2)) WHERE r = 1""")
def best_molecule(t: Tables):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return templates.best_molecule(joined, ["o_custkey"], "o_orderkey", "l_quantity")


@query("""SELECT n_name, min_by(c_name, c_custkey) AS c_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE starts_with(c_name, 'Customer#0000001') GROUP BY 1""")
def prefix_first(t: Tables):
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return templates.first_with_prefix(joined, ["n_name"], "c_name", "Customer#0000001", "c_custkey")


@query("""SELECT doc_id, CASE WHEN length(text) = n_chars - n_chars % 2 THEN 'passed' ELSE 'length ' || length(text) || ' instead of ' || (n_chars - n_chars % 2) END AS result FROM documents""")
def length_check(t: Tables):
    from helixframe.sinks import check_lines

    out = templates.length_check(t.documents, "doc_id", F.col("n_chars") - F.col("n_chars") % 2, F.length("text"))
    return check_lines(out, "doc_id", "result")
