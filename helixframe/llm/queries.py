"""The registered queries of the text operators, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.textbytes import small_batches
from helixframe.session import read_table

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from helixframe.llm.packing import pack_documents

    return pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from helixframe.llm.suffix_dedup import dedup

    return dedup(read_table(spark, sf_dir, "documents"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from helixframe.llm.near_dedup import near_duplicates

    return near_duplicates(read_table(spark, sf_dir, "documents"), percent=85)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from helixframe.llm.licenses import scan_licenses

    found = scan_licenses(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.size("sentence_ids").cast("long").alias("n_sentences"),
                        F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from helixframe.llm.decontamination import scan

    return scan(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def id_remainder(by: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % by


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from helixframe.llm.language_id import identify, train

    docs = read_table(spark, sf_dir, "documents")
    model = train(docs.where(id_remainder(3) != 1))
    flagged = docs.select("doc_id", F.coalesce(id_remainder(3) == 1, F.lit(False)).alias("held_out"), "text")
    return identify(flagged, model, keep=("held_out",))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from helixframe.llm.url_filter import judge_urls, rules_table

    pages = read_table(spark, sf_dir, "pages")
    return judge_urls(pages, rules_table(spark, RULES)).select("page_id", "host", "path", "rule", "verdict")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from helixframe.llm.sharding import shard

    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    return shard(docs, "doc_id", 16, order=("text_crc32", "size")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from helixframe.llm.quality import score, train

    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels").where(id_remainder(5) != 0).select("doc_id", F.col("quality").alias("label"))
    flagged = docs.select("doc_id", F.coalesce(id_remainder(5) == 0, F.lit(False)).alias("held_out"), "text")
    scored = score(flagged, train(docs, labels), keep=("held_out",))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op10_transport_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    from helixframe.llm.media import transport_columns

    return transport_columns(read_table(spark, sf_dir, "documents"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from helixframe.llm.secrets import BASE, scan

    found = scan(read_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in BASE]))
    return found.select("doc_id", *(count(r.kind).alias(f"n_{r.kind}") for r in BASE),
                        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from helixframe.llm.spelling import variant_groups, vocabulary

    return variant_groups(vocabulary(read_table(spark, sf_dir, "documents"), slip_rate=97))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from helixframe.llm.conversation_trie import prefix_trie, turn_rows, with_shared_heads

    return prefix_trie(with_shared_heads(turn_rows(read_table(spark, sf_dir, "conversations"))))


def _tuned(query):
    """The query in a session whose Arrow batches have the size its tasks expect."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {
    "op1_packing": op1_packing,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_near_dedup": op3_near_dedup,
    "op4_license_scan": op4_license_scan,
    "op5_decontamination": op5_decontamination,
    "op6_language_id": op6_language_id,
    "op7_url_filter": op7_url_filter,
    "op8_sharding": op8_sharding,
    "op9_quality": op9_quality,
    "op10_transport_stream": op10_transport_stream,
    "op11_secret_scan": op11_secret_scan,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_conversation_trie": op13_conversation_trie,
}
QUERIES = {name: _tuned(query) for name, query in QUERIES.items()}

_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)


def _license_sql(sentences: list | None = None, rules: list | None = None) -> str:
    """The same sentences and rules in SQL: borders are doubled, so that neighbouring sentences have one each."""
    from helixframe.llm.licenses import RULES, SENTENCES

    sentences, rules = sentences or SENTENCES, rules or RULES
    known = ", ".join(f"('{s}', '{i}')" for i, s in sentences)
    runs = "|".join(s.replace(" ", "(?: |SS)") for s in sorted({s for _, s in sentences}, key=len, reverse=True))
    # rules in one list, folded over the identifiers: names found so far, and what is left of the sequence
    fold = ", ".join(f"{{'name': '{name}', 'run': ',{',,'.join(ids)},'}}" for name, ids in rules)
    cut = "replace(low, chr(13) || chr(10), chr(10))"
    for pattern, mark in ((r"[.!?]([ \t\r\n])", r"H\1"), (r"(?:\r\n?|\n)([^a-z0-9\r\n]*[\r\n])", r"H\1"), (r";([ \t])", r"S\1"), (r"[\r\n]+", "S"), ("[^a-z0-9HS]+", " "), ("[ S]*H[ HS]*", "H"), (" ?S[ S]*", "S")):
        cut = f"regexp_replace({cut}, '{pattern}', '{mark}', 'g')"
    return f"""
WITH known(sentence, id) AS (VALUES {known}),
low AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
cut AS (SELECT doc_id, replace(replace('H' || trim({cut}) || 'H', 'S', 'SS'), 'H', 'HH') AS t FROM low),
parts AS (SELECT doc_id, generate_subscripts(p, 1) AS k, unnest(p) AS part FROM (SELECT doc_id, regexp_extract_all(t, '[HS]({runs})[HS]', 1) AS p FROM cut)),
named AS (SELECT doc_id, k, id FROM parts JOIN known ON replace(part, 'SS', ' ') = sentence),
ids AS (
  SELECT low.doc_id, coalesce(n, 0) AS n, coalesce(j, '') AS j, ',' || coalesce(replace(j, ',', ',,'), '') || ',' AS s
  FROM low LEFT JOIN (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY k) AS j FROM named GROUP BY doc_id) USING (doc_id)),
rules AS (SELECT unnest(generate_series(1, {len(rules)})) AS k, unnest([{fold}]) AS r),
walk AS (
  SELECT doc_id, list_reduce(list_prepend({{'name': '', 'run': s}}, (SELECT list(r ORDER BY k) FROM rules)),
    lambda a, r: {{'name': CASE WHEN contains(a.run, r.run) AND NOT contains(',' || a.name || ',', ',' || r.name || ',') THEN a.name || CASE WHEN a.name = '' THEN '' ELSE ',' END || r.name ELSE a.name END,
                  'run': replace(a.run, r.run, ',')}}) AS w
  FROM ids WHERE n > 0)
SELECT ids.doc_id, n AS n_sentences, j AS sentence_ids, coalesce(w.name, '') AS licenses FROM ids LEFT JOIN walk USING (doc_id)
"""


_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_NEAR_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, string_split(trim(regexp_replace({_LOW}, '[ \\x09-\\x0D]+', ' ', 'g'), ' '), ' ') AS t FROM documents),
sized AS (SELECT doc_id, t, CASE WHEN t[1] = '' THEN 0 ELSE len(t) END AS n FROM w),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(t[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, t, unnest(range(1, greatest(n - 4, 1) + 1)) AS i FROM sized WHERE n > 0)),
counts AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN counts x ON x.doc_id = a JOIN counts y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
twoway AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(n, m) AS (SELECT a, a FROM twoway UNION SELECT twoway.b, reach.m FROM reach JOIN twoway ON twoway.a = reach.n),
low AS (SELECT n, min(m) AS m FROM reach GROUP BY n)
SELECT d.doc_id, coalesce(c.n, 0) AS n_shingles, coalesce(m, d.doc_id) AS component_id, coalesce(m, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN counts c ON c.doc_id = d.doc_id LEFT JOIN low ON low.n = d.doc_id
"""

_LEAKS_SQL = f"""
WITH d AS (
  SELECT doc_id, string_split(trim(regexp_replace({_LOW}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g'), ' '), ' ') AS t FROM documents),
docs AS (SELECT doc_id, t, CASE WHEN t[1] = '' THEN 0 ELSE len(t) END AS n FROM d),
i AS (
  SELECT item_id, string_split(trim(regexp_replace({_LOW}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g'), ' '), ' ') AS t FROM benchmark),
items AS (SELECT item_id, t, len(t) AS n, least(len(t), 10) AS k FROM i WHERE t[1] <> ''),
wanted AS (
  SELECT DISTINCT item_id, k, array_to_string(t[p:p + k - 1], ' ') AS w
  FROM (SELECT item_id, t, k, unnest(range(1, n - k + 2)) AS p FROM items)),
runs AS (
  SELECT doc_id, k, p, array_to_string(t[p:p + k - 1], ' ') AS w
  FROM (SELECT doc_id, t, k, unnest(range(1, n - k + 2)) AS p FROM docs, (SELECT DISTINCT k FROM items) WHERE n >= k)),
hits AS (SELECT doc_id, p, k, item_id FROM runs JOIN wanted USING (k, w)),
spots AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT docs.doc_id, CAST(n AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN spots ON spots.doc_id = docs.doc_id LEFT JOIN named ON named.doc_id = docs.doc_id
"""



def _secret_sql() -> str:
    """Matches and the pieces between them, rule by rule; a match starts behind the pieces and matches before it."""
    from helixframe.llm.secrets import BASE, RULES as rules

    quoted = lambda pattern: "'" + pattern.replace("'", "''") + "'"
    of = "\nUNION ALL\n".join(f"""SELECT doc_id, {k} AS k, '{r.kind}' AS kind, {quoted(r.keep or r.pattern)} AS keep,
  regexp_extract_all(text, {quoted(r.pattern)}) AS m, string_split_regex(text, {quoted(r.pattern)}) AS p
FROM documents WHERE regexp_matches(text, {quoted(r.pattern)})""" for k, r in enumerate(rules))
    named = "kind || ':' || s || ':' || (s + length(found))"
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE)
    kinds = ", ".join(f"'{r.kind}'" for r in BASE)
    return f"""
WITH hits AS ({of}),
each AS (SELECT doc_id, k, kind, keep, m, p, unnest(range(1, len(m) + 1)) AS i FROM hits),
placed AS (
  SELECT doc_id, k, kind, keep, m[i] AS found,
    CAST(list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s FROM each),
spans AS (SELECT * FROM placed WHERE regexp_full_match(found, keep)),
told AS (
  SELECT doc_id, {counts}, string_agg({named}, ',' ORDER BY s, k) FILTER (kind IN ({kinds})) AS base, string_agg({named}, ',' ORDER BY s, k) AS spans
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN told ON told.doc_id = d.doc_id
"""




def _crc_sql(values: str) -> str:
    """The unsigned crc32 of a list of bytes, beside ``crc_table``."""
    return (f"xor(list_reduce({values}, lambda a, b: xor(a >> 8, t[CAST(xor(a, b) & 255 AS INT) + 1]), CAST(4294967295 AS UBIGINT)), "
            "CAST(4294967295 AS UBIGINT))")


_BIT = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS UBIGINT)) ELSE x >> 1 END"
_CRC_TABLE = f"""crc_rounds(i, k, x) AS (
  SELECT i, 0, CAST(i AS UBIGINT) FROM range(256) AS r(i) UNION ALL SELECT i, k + 1, {_BIT} FROM crc_rounds WHERE k < 8),
crc_table AS (SELECT list(x ORDER BY i) AS t FROM crc_rounds WHERE k = 8)"""


def _spelling_sql() -> str:
    utf8 = ("flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS UBIGINT)] "
            "ELSE [CAST(192 + (unicode(c) >> 6) AS UBIGINT), CAST(128 + (unicode(c) & 63) AS UBIGINT)] END))")
    return f"""
WITH RECURSIVE {_CRC_TABLE},
found AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents WHERE text IS NOT NULL),
kept AS (SELECT doc_id, run, count(*) AS n FROM found GROUP BY ALL),
hashed AS (SELECT run, n, {_crc_sql(utf8)} AS h FROM kept, crc_table WHERE length(run) >= 5),
slipped AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word AS word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON w.word = c.rest
  UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON w.word = c.rest),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS near_n FROM pairs GROUP BY word),
forms AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN best.near_n >= 2 * words.n THEN best.near_n END AS form_n,
    CASE WHEN best.near_n >= 2 * words.n THEN (SELECT min(p.near) FROM pairs p WHERE p.word = words.word AND p.near_n = best.near_n) END AS form
  FROM words LEFT JOIN best ON best.word = words.word),
walk(word, last, k) AS (SELECT word, word, 0 FROM forms UNION ALL SELECT walk.word, forms.form, k + 1 FROM walk JOIN forms ON forms.word = walk.last WHERE forms.form IS NOT NULL),
roots AS (SELECT word, max_by(last, k) AS root FROM walk GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""



def _trie_sql() -> str:
    digits = "list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(unicode(x) AS UBIGINT))"
    return f"""
WITH RECURSIVE {_CRC_TABLE},
turns AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS p,
    md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS t,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT c, c - c % 20 AS base, {_crc_sql(digits)} % 4 AS h FROM (SELECT DISTINCT c FROM turns), crc_table),
rebuilt AS (
  SELECT ids.c, 0 AS part, p, t, tokens FROM ids JOIN turns ON turns.c = base WHERE p < h
  UNION ALL SELECT ids.c, 1, p, t, tokens FROM ids JOIN turns ON turns.c = ids.c WHERE p >= h),
placed AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, p) AS d, t, tokens FROM rebuilt),
paths AS (
  SELECT c, d, string_agg(t, '') OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING) AS path, tokens FROM placed
  UNION ALL SELECT c, 0, '', 0 FROM ids),
lens AS (SELECT c, max(d) AS n FROM paths GROUP BY c),
nodes AS (SELECT path, d, min(c) AS conv_id, count(*) AS n_convs, any_value(tokens) AS tokens FROM paths GROUP BY path, d),
kids AS (SELECT left(path, 32 * (d - 1)) AS path, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (path)),
below AS (
  SELECT left(path, 32 * CAST(a AS INT)) AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * tokens) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM full_nodes) GROUP BY 1),
ends AS (SELECT path, string_agg(CAST(paths.c AS VARCHAR), ',' ORDER BY paths.c) AS list FROM paths JOIN lens ON lens.c = paths.c AND d = n GROUP BY path)
SELECT f.conv_id, f.d AS depth, up.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
  sha256(coalesce(list, '')) AS ends_sha256
FROM full_nodes f JOIN below ON below.path = f.path LEFT JOIN ends ON ends.path = f.path
LEFT JOIN nodes up ON f.d > 0 AND up.path = left(f.path, 32 * CAST(f.d - 1 AS INT))
"""



def _redirect_sql() -> str:
    """Rules, the edges that pages' canonical links and refreshes make, and the closure over them."""
    low = lambda x: f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    rest = lambda u: f"(CASE WHEN strpos({u}, '://') > 0 THEN substr({u}, strpos({u}, '://') + 3) END)"
    host = lambda u: f"coalesce({low(f'regexp_extract({rest(u)}, {chr(39)}^[^/?#]*{chr(39)})')}, '')"
    path = lambda u: f"coalesce(regexp_extract({rest(u)}, '^[^/?#]*([^?#]*)', 1), '')"
    scheme = lambda u: low(f"regexp_extract({u}, '^[^:/?#]*')")
    node = lambda u: f"CASE WHEN strpos({u}, '://') > 0 THEN {scheme(u)} || '://' || {host(u)} || {path(u)} || regexp_extract({u}, '^[^?#]*(\\?[^#]*)', 1) END"
    fits = "(host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)"
    ruled = lambda of: f"""SELECT *, (SELECT max_by(rh || rp, length(rh || rp)) FROM rules WHERE {fits}) AS rule,
    (SELECT max_by(v, length(rh || rp)) FROM rules WHERE {fits}) AS own FROM {of}"""  # noqa: E731
    quote, word = "[\"'']?", "([^\"''\\s>]+)"
    return f"""
WITH RECURSIVE rules(rh, rp, v) AS (VALUES {_RULES_SQL}),
q AS (SELECT page_id, url, {host('url')} AS host, {path('url')} AS path FROM pages),
best AS ({ruled('q')}),
tags AS (SELECT url, unnest(regexp_extract_all(html, '(?i)<(?:link|meta)\\b[^>]*>')) AS tag FROM pages WHERE url IS NOT NULL),
targets AS (
  SELECT url, regexp_extract(tag, '(?i)\\bhref\\s*=\\s*{quote}{word}', 1) AS t FROM tags WHERE regexp_matches(tag, '(?i)\\brel\\s*=\\s*{quote}canonical\\b')
  UNION SELECT url, regexp_extract(tag, '(?i)\\burl\\s*=\\s*{quote}{word}', 1) FROM tags WHERE regexp_matches(tag, '(?i)\\bhttp-equiv\\s*=\\s*{quote}refresh\\b')),
cut AS (
  SELECT url, t, regexp_extract(url, '^[^:/?#]*') AS scheme, regexp_extract(url, '^[^:/?#]*') || '://' || {host('url')} AS origin, {path('url')} AS path,
    regexp_extract({path('url')}, '^.*/') AS folder, regexp_extract(t, '^[^?#]*') AS tp, regexp_extract(t, '^[^?#]*(.*)$', 1) AS tr FROM targets WHERE t <> ''),
steps AS (SELECT *, string_split(CASE WHEN starts_with(tp, '/') THEN tp ELSE CASE WHEN folder = '' THEN '/' ELSE folder END || tp END, '/') AS s FROM cut),
walked AS (
  SELECT *, list_reduce(list_prepend(CAST([] AS VARCHAR[]), list_transform(s, lambda x: [x])), lambda a, x: CASE
    WHEN x[1] = '..' THEN a[1:CASE WHEN len(a) > 1 THEN len(a) - 1 ELSE len(a) END] WHEN x[1] = '.' THEN a ELSE list_concat(a, x) END) AS kept FROM steps),
full_urls AS (
  SELECT url, CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t WHEN starts_with(t, '//') THEN scheme || ':' || t
    WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL WHEN tp = '' THEN origin || path || tr
    ELSE origin || array_to_string(kept, '/') || CASE WHEN s[-1] IN ('.', '..') THEN '/' ELSE '' END || tr END AS target FROM walked),
edges AS (SELECT DISTINCT src, dst FROM (SELECT {node('url')} AS src, {node('target')} AS dst FROM full_urls) WHERE src <> dst),
twoway AS (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges),
reach(n, m) AS (SELECT src, src FROM twoway UNION SELECT reach.n, dst FROM reach JOIN twoway ON src = reach.m),
spots AS (SELECT n AS node, {host('n')} AS host, {path('n')} AS path FROM (SELECT DISTINCT n FROM reach)),
known AS ({ruled('spots')}),
passed AS (SELECT n, CASE WHEN bool_or(own = 'allow') THEN 'allow' ELSE 'block' END AS verdict FROM reach JOIN known ON known.node = m WHERE own IS NOT NULL GROUP BY n)
SELECT page_id, host, path, rule, coalesce(own, passed.verdict, 'allow') AS verdict FROM best LEFT JOIN passed ON passed.n = {node('url')}
"""


ORACLES = {
    "op13_conversation_trie": _trie_sql(),
    "op12_spelling_variants": _spelling_sql(),
    "op11_secret_scan": _secret_sql(),
    "op3_near_dedup": _NEAR_SQL,
    "op5_decontamination": _LEAKS_SQL,
    "op4_license_scan": _license_sql(),
    "op7_url_filter": _redirect_sql(),
}
