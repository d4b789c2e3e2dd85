"""URL filter by redirect equivalence, in DataFrame functions only.

Rules are (host, path, verdict). A rule fits its host and every subdomain if
the URL's path starts with the rule's path; the longest ``host + path`` wins
(on equal length an allow wins). URLs without a rule of their own take part in
redirect equivalence: redirect and canonical-link edges are grouped by
connected components, and a component's decision reaches its members. An
explicit allow in a component takes precedence over its blocks; a component
without any rule is allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.operators.components import connected_components
from helixframe.session import materialize

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3)))
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, UPPER.lower()), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty where there is no ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3)))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def url_node(url: Column) -> Column:
    """The URL as a graph node: without its fragment, host lower-cased."""
    scheme = F.translate(F.regexp_extract(url, r"^[^:/?#]*", 0), UPPER, UPPER.lower())
    query = F.regexp_extract(url, r"^[^?#]*(\?[^#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(scheme, F.lit("://"), url_host(url), url_path(url), query))


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """A literal (rule_host, rule_path, verdict) table."""
    rows = F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(("rule_host", "rule_path", "verdict"), r))) for r in rules))
    return spark.range(1).select(F.inline(rows))


def _placed(urls: DataFrame, host: Column, path: Column) -> DataFrame:
    """``row, host, path``: the caller's columns stay together in ``row``, so none can clash."""
    return urls.select(F.struct("*").alias("row"), host.alias("host"), path.alias("path"))


def _ruled(placed: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds ``rule`` and ``own`` (its verdict) to placed rows.

    Each distinct (host, path) is looked up once: its host is exploded into as
    many domain suffixes as the longest rule has labels, its path into prefixes
    of the lengths that the rules of such a suffix have, and both together meet
    the rules by equality. A host may have any number of rules.
    """
    rules = rules.select("rule_host", "rule_path", "verdict").where("rule_host IS NOT NULL AND rule_path IS NOT NULL")
    labels = rules.agg(F.max(F.size(F.split("rule_host", r"\."))).alias("n")).first()["n"] or 0
    ends = F.array_distinct(F.array(*(F.substring_index("host", ".", -i) for i in range(1, max(labels, 1) + 1))))
    lengths = rules.select("rule_host", F.length("rule_path").alias("_n")).distinct()
    probes = placed.select("host", "path").distinct().select("host", "path", F.explode(ends).alias("rule_host"))
    probes = probes.join(lengths, "rule_host").where(F.col("_n") <= F.length("path")).select("host", "path", "rule_host", F.expr("left(path, _n)").alias("rule_path"))
    rule = F.concat("rule_host", "rule_path")
    best = F.max(F.struct(F.length(rule).alias("n"), (F.col("verdict") == "allow").alias("allow"), rule.alias("rule"), "verdict")).alias("best")
    hits = probes.join(rules, ["rule_host", "rule_path"]).groupBy("host", "path").agg(best)
    return placed.join(hits, ["host", "path"], "left").select("row", "host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("own"))


def match_rules(urls: DataFrame, rules: DataFrame, host: str = "host", path: str = "path") -> DataFrame:
    """Adds ``rule`` and ``rule_verdict`` (null without a fitting rule), in place of columns of these names."""
    kept = [c for c in urls.columns if c not in ("rule", "rule_verdict")]
    found = _ruled(_placed(urls, F.col(host), F.col(path)), rules)
    return found.select(*(F.col("row")[c].alias(c) for c in kept), "rule", F.col("own").alias("rule_verdict"))


def resolve(url: Column, target: Column) -> Column:
    """A link's target seen from a page's url: absolute, ``//host``, ``/path``, ``?query`` or relative, dot segments resolved."""
    scheme = F.regexp_extract(url, r"^[^:/?#]*", 0)
    origin = F.concat(scheme, F.lit("://"), url_host(url))
    folder = F.regexp_extract(url_path(url), r"^.*/", 0)
    path, rest = F.regexp_extract(target, r"^[^?#]*", 0), F.regexp_extract(target, r"^[^?#]*(.*)$", 1)
    full = F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(F.when(folder == "", "/").otherwise(folder), path))
    steps = F.split(full, "/")
    kept = F.aggregate(
        steps, F.array().cast("array<string>"),
        lambda acc, x: F.when(x == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.least(F.size(acc), F.lit(1))))).when(x == ".", acc).otherwise(F.concat(acc, F.array(x))))
    ends = F.when(F.element_at(steps, -1).isin(".", ".."), "/").otherwise("")
    return (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(F.startswith(target, F.lit("//")), F.concat(scheme, F.lit(":"), target))
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") | (target == ""), F.lit(None).cast("string"))
        .when(path == "", F.concat(origin, url_path(url), rest))
        .otherwise(F.concat(origin, F.array_join(kept, "/"), ends, rest))
    )


def html_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(src, dst)`` nodes from all canonical links and meta-refresh redirects.

    Targets are resolved against the page's url; other schemes (``mailto:``)
    and targets equal to the page itself are left out. Null html or url: none.
    """
    body = F.col(html)
    tags = lambda word: F.regexp_extract_all(body, F.lit(rf"(?i)<(?:link|meta)\b(?=[^>]*{word})[^>]*>"), F.lit(0))
    target = lambda found, name: F.transform(found, lambda t: F.regexp_extract(t, rf"(?i)\b{name}\s*=\s*[\"']?([^\"'\s>]+)", 1))
    canon = target(tags(r"\brel\s*=\s*[\"']?canonical\b"), "href")
    fresh = target(tags(r"\bhttp-equiv\s*=\s*[\"']?refresh\b"), "url")
    lower = F.lower(body)
    return (
        pages.where(F.col(url).isNotNull() & (lower.contains("canonical") | lower.contains("http-equiv")))
        .select(F.col(url).alias("_u"), F.explode(F.array_distinct(F.concat(canon, fresh))).alias("_t"))
        .where("_t <> ''")
        .select(url_node(F.col("_u")).alias("src"), url_node(resolve(F.col("_u"), F.col("_t"))).alias("dst"))
        .where("src <> dst")
    )


def judge_urls(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None,
               url: str = "url", html: str | None = "html") -> DataFrame:
    """Adds ``host, path, rule, verdict`` to every row of ``pages``.

    ``redirects`` (src, dst URLs) adds edges from a crawl log. Null URLs and
    URLs without ``://`` have empty host and path, match no rule and are
    allowed. Repeated rows stay repeated; an empty table stays empty. Columns
    of these names in ``pages`` are replaced.
    """
    clash = {"host", "path", "rule", "verdict"}
    keep = [c for c in pages.columns if c not in clash and c != html]
    edges = None
    if html is not None:
        edges = html_edges(pages, url, html)
    if redirects is not None:
        more = redirects.select(url_node(F.col("src")).alias("src"), url_node(F.col("dst")).alias("dst")).where("src <> dst")
        edges = more if edges is None else edges.unionAll(more)
    judged = _ruled(_placed(pages.select(*keep), url_host(F.col(url)), url_path(F.col(url))), rules)
    columns = [*(F.col("row")[c].alias(c) for c in keep), "host", "path", "rule"]
    if edges is None:
        return judged.select(*columns, F.coalesce("own", F.lit("allow")).alias("verdict"))
    edges = materialize(edges.distinct(), "url-edges")
    groups = connected_components(edges)
    decided = (
        _ruled(_placed(groups, url_host(F.col("node")), url_path(F.col("node"))), rules).where("rule is not null").groupBy("row.component")
        .agg(F.when(F.max(F.col("own") == "allow"), "allow").otherwise("block").alias("passed"))
    )
    aliases = groups.join(decided, "component").select("node", "passed")
    named = judged.withColumn("node", url_node(F.col("row")[url]))
    return named.join(aliases, "node", "left").select(*columns, F.coalesce("own", "passed", F.lit("allow")).alias("verdict"))
