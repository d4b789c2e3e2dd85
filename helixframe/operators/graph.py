"""Graph operators over node and edge tables."""

from __future__ import annotations

import sys
from functools import reduce
from itertools import groupby
from operator import add, and_, or_

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixframe.operators.components import connected_components
from helixframe.session import materialize

# fixed values: category order of edge counts; B counts as L and Q as P
CATEGORY_ORDER = ["P", "A", "D", "R", "N", "L"]


def sorted_pair(df: DataFrame, a: str, b: str, out: tuple[str, str] = ("src", "dst")) -> DataFrame:
    return df.withColumns({out[0]: F.least(a, b), out[1]: F.greatest(a, b)})


def molecule_graphs(chains: DataFrame, contacts: DataFrame, key: str, node: str, label: str, src: str, dst: str) -> tuple[DataFrame, DataFrame]:
    """Node table ``gid, node, label`` and edge table ``gid, u, v`` (``u < v``, no repeats)."""
    nodes = chains.select(F.col(key).alias("gid"), F.col(node).alias("node"), F.col(label).alias("label")).distinct()
    edges = contacts.where(F.col(src) != F.col(dst)).select(
        F.col(key).alias("gid"), F.least(src, dst).alias("u"), F.greatest(src, dst).alias("v")).distinct()
    return nodes, edges


def node_places(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``place``: every graph's nodes numbered from 0 in their order."""
    return nodes.withColumn("place", (F.row_number().over(Window.partitionBy("gid").orderBy("node", "label")) - 1).cast("long"))


def graph_rows(placed: DataFrame, edges: DataFrame) -> DataFrame:
    """``gid, kind, src, dst, node, label``: graphs as one table.

    A row of kind ``node`` has a node's place as ``src`` and ``dst``, its name and
    label; one of kind ``edge`` has the places of both ends. So a graph of any
    size is rows, and one without edges has its nodes.
    """
    none = F.lit(None).cast("string")
    place = F.col("place")
    nodes = placed.select("gid", F.lit("node").alias("kind"), place.alias("src"), place.alias("dst"), F.col("node").cast("string").alias("node"), F.col("label").cast("string").alias("label"))
    return nodes.unionByName(edges.select("gid", F.lit("edge").alias("kind"), F.col("u").alias("src"), F.col("v").alias("dst"), none.alias("node"), none.alias("label")))


def edge_labels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``gid, a, b``: the distinct sorted label pairs of every graph's edges."""
    u = nodes.select("gid", F.col("node").alias("u"), F.col("label").alias("lu"))
    v = nodes.select("gid", F.col("node").alias("v"), F.col("label").alias("lv"))
    return edges.join(u, ["gid", "u"]).join(v, ["gid", "v"]).select("gid", F.least("lu", "lv").alias("a"), F.greatest("lu", "lv").alias("b")).distinct()


def share_a_node(nodes: DataFrame, other: DataFrame) -> DataFrame:
    """``gid`` of graphs with a label that also occurs in ``other``."""
    return nodes.join(other.select("label").distinct(), "label", "left_semi").select("gid").distinct()


def share_an_edge(labels: DataFrame, other: DataFrame) -> DataFrame:
    return labels.join(other.select("a", "b").distinct(), ["a", "b"], "left_semi").select("gid").distinct()


def edge_clusters(labels: DataFrame, gid: str = "gid", keys: tuple[str, ...] = ("a", "b")) -> DataFrame:
    """``gid, cluster``: graphs connected through shared edge labels, by smallest member.

    Every label links its graphs to the smallest one (as many links as rows),
    never graph to graph.
    """
    rows = labels.select(gid, *keys)
    # a minimum is combined before it moves, so a hot label costs rows, not one task's sort
    low = rows.groupBy(*keys).agg(F.min(gid).alias("_low"))
    links = rows.join(low, list(keys)).select(F.col(gid).alias("src"), F.col("_low").alias("dst"))
    return connected_components(links).withColumnRenamed("node", "gid").withColumnRenamed("component", "cluster")


def component_numbers(labels: DataFrame, member: str, component: str, out: str = "cluster_no") -> DataFrame:
    """Components numbered from 0 by their smallest member."""
    from helixframe.operators.sequences import global_rank

    heads = labels.select(component).distinct()
    return labels.join(global_rank(heads, [component], out), component)


def category_counts(edges: DataFrame, a: str, b: str, place: int = 1) -> DataFrame:
    """``category, n`` for all 21 sorted category pairs, zeros included."""
    spark = edges.sparkSession

    def char(c: str):
        x = F.substring(c, place, 1)
        return F.when(x == "B", "L").when(x == "Q", "P").otherwise(x)

    order = F.array(*(F.lit(c) for c in CATEGORY_ORDER))
    rows = edges.select(char(a).alias("x"), char(b).alias("y")).where(F.col("x").isin(CATEGORY_ORDER) & F.col("y").isin(CATEGORY_ORDER))
    px, py = F.array_position(order, F.col("x")), F.array_position(order, F.col("y"))
    counted = rows.select(F.when(px <= py, F.concat("x", "y")).otherwise(F.concat("y", "x")).alias("category")).groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    every = [(x + y,) for i, x in enumerate(CATEGORY_ORDER) for y in CATEGORY_ORDER[i:]]
    keys = spark.createDataFrame(every, "category string")
    return keys.join(counted, "category", "left").select("category", F.coalesce("n", F.lit(0)).alias("n"))


def split_by_components(edges: DataFrame, a: str, b: str) -> tuple[DataFrame, DataFrame]:
    """Labels ``node, component`` and sizes ``component, n_nodes, n_edges``, largest first by n_nodes."""
    labels = materialize(connected_components(edges, a, b), "components")
    nodes = labels.groupBy("component").agg(F.count(F.lit(1)).alias("n_nodes"))
    links = edges.join(labels.withColumnRenamed("node", a), a).groupBy("component").agg(F.count(F.lit(1)).alias("n_edges"))
    return labels, nodes.join(links, "component")


def leakage_free(train: DataFrame, valid: DataFrame, interactions: DataFrame, polymers: list[str], a: str = "c1", b: str = "c2",
                 cluster: str = "cluster_id", place: int = 2) -> DataFrame:
    """Validation clusters outside every component that holds a training polymer cluster.

    Only interactions between polymer clusters connect; other clusters stay.
    """
    is_polymer = lambda c: F.substring(c, place, 1).isin(polymers)
    edges = interactions.where(is_polymer(a) & is_polymer(b))
    labels = materialize(connected_components(edges, a, b), "leak")
    known = train.where(is_polymer(cluster)).select(F.col(cluster).alias("node")).distinct()
    tainted = labels.join(known, "node", "left_semi").select("component").distinct()
    bad = labels.join(tainted, "component", "left_semi").select(F.col("node").alias(cluster)).unionByName(known.select(F.col("node").alias(cluster)))
    return valid.select(cluster).distinct().join(bad.distinct(), cluster, "left_anti")


def extract_edges(edges: DataFrame, wanted: DataFrame, a: str, b: str) -> DataFrame:
    """Edge rows whose pair is wanted in either orientation."""
    keys = wanted.select(F.least(a, b).alias("_a"), F.greatest(a, b).alias("_b")).distinct()
    return edges.join(keys, (F.least(a, b) == F.col("_a")) & (F.greatest(a, b) == F.col("_b")), "left_semi")


def interacting_ids(contacts: DataFrame, chains: DataFrame, key: str, chain: str, value: str, src: str, dst: str) -> DataFrame:
    """Distinct sorted pairs of chain values over all contacts."""
    x = chains.select(key, F.col(chain).alias(src), F.col(value).alias("_x"))
    y = chains.select(key, F.col(chain).alias(dst), F.col(value).alias("_y"))
    return contacts.join(x, [key, src]).join(y, [key, dst]).select(F.least("_x", "_y").alias("id1"), F.greatest("_x", "_y").alias("id2")).distinct()


def lift_pairs(pairs: DataFrame, members: DataFrame, member: str, cluster: str, last_wins: bool = False, order: str | None = None) -> DataFrame:
    """Pairs of ids as distinct sorted pairs of clusters.

    ``last_wins`` keeps only the last pair of every first id, by ``order``.
    """
    if last_wins:
        w = Window.partitionBy("id1").orderBy(F.col(order).desc())
        pairs = pairs.withColumn("_r", F.row_number().over(w)).where("_r = 1")
    x = members.select(F.col(member).alias("id1"), F.col(cluster).alias("_x"))
    y = members.select(F.col(member).alias("id2"), F.col(cluster).alias("_y"))
    return pairs.join(x, "id1").join(y, "id2").select(F.least("_x", "_y").alias("c1"), F.greatest("_x", "_y").alias("c2")).distinct()


def refine_colours(nodes: DataFrame, edges: DataFrame, rounds: int = 3) -> DataFrame:
    """``gid, node, label, colour`` after rounds of colour refinement.

    A colour is a hash of the node's own colour and its neighbours' sorted
    colours, so it doesn't depend on how nodes are numbered.
    """
    both = edges.select("gid", "u", "v").unionAll(edges.select("gid", F.col("v").alias("u"), F.col("u").alias("v")))
    state = nodes.withColumn("colour", F.sha2(F.coalesce("label", F.lit("")), 256))
    for _ in range(rounds):
        around = both.join(state.select("gid", F.col("node").alias("v"), "colour"), ["gid", "v"]).groupBy("gid", F.col("u").alias("node")).agg(
            F.array_join(F.sort_array(F.collect_list("colour")), ",").alias("_near"))
        state = state.join(around, ["gid", "node"], "left").withColumn(
            "colour", F.sha2(F.concat_ws("|", "colour", F.coalesce("_near", F.lit(""))), 256)).drop("_near")
    return state


def graph_hashes(nodes: DataFrame, edges: DataFrame, rounds: int = 3) -> DataFrame:
    """``gid, hash, n_nodes``: equal for isomorphic graphs."""
    colours = refine_colours(nodes, edges, rounds)
    return colours.groupBy("gid").agg(F.sha2(F.array_join(F.sort_array(F.collect_list("colour")), ","), 256).alias("hash"), F.count(F.lit(1)).alias("n_nodes"))


def isomorphic(a: tuple[dict, set], b: tuple[dict, set]) -> bool:
    """Exact test of two small labelled graphs ``({node: label}, {(u, v)})`` by backtracking."""
    (la, ea), (lb, eb) = a, b
    if len(la) != len(lb) or len(ea) != len(eb) or sorted(la.values()) != sorted(lb.values()):
        return False
    near = lambda e: {n: {y if x == n else x for x, y in e if n in (x, y)} for n in {k for p in e for k in p}}
    na, nb = near(ea), near(eb)
    order = sorted(la, key=lambda n: -len(na.get(n, ())))

    def match(i: int, image: dict) -> bool:
        if i == len(order):
            return True
        n = order[i]
        for m in lb:
            if m in image.values() or la[n] != lb[m] or len(na.get(n, ())) != len(nb.get(m, ())):
                continue
            if all((image[k] in nb.get(m, ())) == (k in na.get(n, ())) for k in order[:i]):
                if match(i + 1, image | {n: m}):
                    return True
        return False

    return match(0, {})


def _sums(*values: str) -> list[Column]:
    """Two sums of hashes: the same for the same rows in any order, and no list of them is kept."""
    return [F.sum(F.xxhash64(F.lit(k), *values).cast("decimal(38,0)")) for k in (1, 2)]


def _digest(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat_ws("|", *parts)))


def _coloured(links: DataFrame, state: DataFrame) -> DataFrame:
    """``gid, u, v, cu, cv``: links with their ends' colours; one with an end that isn't a node is left out."""
    end = lambda e: state.select("gid", F.col("node").alias(e), F.col("colour").alias(f"c{e}"))
    return links.select("gid", "u", "v").join(end("u"), ["gid", "u"]).join(end("v"), ["gid", "v"])


def _recoloured(state: DataFrame, links: DataFrame) -> DataFrame:
    """A round of refinement: a node's own colour and the sums of its neighbours' hashed colours, so a hub costs rows."""
    one, two = _sums("near")
    ends = links.select("gid", F.col("u").alias("node"), F.col("cv").alias("near")).unionAll(links.select("gid", F.col("v").alias("node"), F.col("cu").alias("near")))
    around = ends.groupBy("gid", "node").agg(one.alias("_1"), two.alias("_2"))
    colour = _digest(F.hex("colour"), *(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ("_1", "_2")))
    return state.join(around, ["gid", "node"], "left").select("gid", "node", colour.alias("colour"))


def colour_blocks(cells: DataFrame, links: DataFrame) -> DataFrame:
    """``gid, a, b, na, nb, e, open``: links between every two colours that have some, and within a colour.

    ``open`` is the number of links or of missing ones, whichever is less; it
    is 0 where every node of one colour is linked to every node of the other.
    """
    pairs = links.groupBy("gid", F.least("cu", "cv").alias("a"), F.greatest("cu", "cv").alias("b")).agg(F.count("*").alias("e"))
    size = lambda c: cells.select("gid", F.col("colour").alias(c), F.col("n").alias(f"n{c}"))
    whole = F.when(F.col("a") == F.col("b"), F.expr("na * (na - 1) div 2")).otherwise(F.col("na") * F.col("nb"))
    return pairs.join(size("a"), ["gid", "a"]).join(size("b"), ["gid", "b"]).withColumn("open", F.least(F.col("e"), whole - F.col("e")))


def cyclic_graphs(blocks: DataFrame) -> DataFrame:
    """``gid`` of graphs whose open links hold a cycle; ``blocks`` are those of a stable colouring.

    Nodes with at most one open link are taken off until none is left, a colour
    at a time, as the nodes of a colour have equally many.
    """
    rest, stuck = materialize(blocks.where("open > 0").select("gid", "a", "b", "na", "nb", "open"), "open-links"), None
    while True:
        ends = rest.select("gid", F.col("a").alias("colour"), F.col("na").alias("n"), "open").unionAll(rest.select("gid", F.col("b").alias("colour"), F.col("nb").alias("n"), "open"))
        leaves = materialize(ends.groupBy("gid", "colour", "n").agg(F.sum("open").alias("m")).where("m <= n").select("gid", "colour"), "leaves")
        none = rest.join(leaves, "gid", "left_anti").select("gid")
        stuck = none if stuck is None else stuck.unionAll(none)
        left = rest.join(leaves, "gid", "left_semi")
        for end in "ab":
            left = left.join(leaves.withColumnRenamed("colour", end), ["gid", end], "left_anti")
        rest = materialize(left, "open-links")
        if rest.isEmpty():
            return stuck.distinct()


#: Distinct nodes of a graph up to which it is settled whole in a task, beside others; rows of graphs settled together.
SMALL_GRAPH, GRAPH_ROWS = 2048, 1 << 18


def _mixed(*parts) -> np.ndarray:
    """A 64-bit hash of numbers, element by element."""
    h = np.array([0x9E3779B97F4A7C15], np.uint64)
    for p in parts:
        h = (h ^ np.asarray(p).astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h = h ^ (h >> np.uint64(31))
    return h


def _added(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size, np.uint64)
    np.add.at(out, at, values)
    return out


def _cells(owner: np.ndarray, colours: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The cell of every node, by graph and colour, and a node of every cell."""
    order = np.lexsort((*colours, owner))
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in (owner, *colours)])
    cell = np.empty(len(order), np.int64)
    cell[order] = np.cumsum(new) - 1
    return cell, order[new]


def _cyclic(of: np.ndarray, n: np.ndarray, lo: np.ndarray, hi: np.ndarray, left: np.ndarray, graphs: int) -> np.ndarray:
    """``cyclic_graphs`` of cells: whether a graph's open links hold a cycle."""
    stuck = np.zeros(graphs, bool)
    while len(lo):
        m = np.bincount(np.concatenate([lo, hi]), np.concatenate([left, left]), len(n))
        leaf = (m > 0) & (m <= n)
        some = np.zeros(graphs, bool)
        some[of[leaf]] = True
        stuck[of[lo[~some[of[lo]]]]] = True
        rest = some[of[lo]] & ~leaf[lo] & ~leaf[hi]
        lo, hi, left = lo[rest], hi[rest], left[rest]
    return stuck


def _graph_forms(graphs: int, of: np.ndarray, name: np.ndarray, labels: list[np.ndarray], at: np.ndarray, u: np.ndarray, v: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Two hashes of the form of every graph, and whether it needs a string instead; see ``graph_dedup``.

    Nodes have their graph ``of``, a name and a colour in ``labels``, links their graph ``at`` and two names.
    """
    owners, names = np.concatenate([of, at, at]), np.concatenate([name, u, v])
    ids, first = _cells(owners, [names])
    owner, total = owners[first], len(first)
    colours = [np.zeros(total, np.uint64) for _ in labels]
    for c, own in zip(colours, labels):
        np.maximum.at(c, ids[: len(of)], own)
    known = np.zeros(total, bool)
    known[ids[: len(of)]] = True
    x, y = ids[len(of) : len(of) + len(at)], ids[len(of) + len(at) :]
    links = np.unique((np.minimum(x, y) * total + np.maximum(x, y))[known[x] & known[y]])
    a, b = links // total, links % total
    hard = np.zeros(graphs, bool)
    hard[owner[a[a == b]]] = True
    forms, going = [np.zeros(graphs, np.uint64) for _ in range(2)], ~hard
    while True:
        kept = known & going[owner]
        links = kept[a]
        place = np.cumsum(kept) - 1
        a, b, owner, colours, known = place[a[links]], place[b[links]], owner[kept], [c[kept] for c in colours], known[kept]
        if not len(owner):
            return forms, hard
        cell, head = _cells(owner, colours)
        home, n, tint = owner[head], np.bincount(cell), [c[head] for c in colours]
        pairs, e = np.unique(np.minimum(cell[a], cell[b]) * len(n) + np.maximum(cell[a], cell[b]), return_counts=True)
        lo, hi = pairs // len(n), pairs % len(n)
        left = np.minimum(e, np.where(lo == hi, n[lo] * (n[lo] - 1) // 2, n[lo] * n[hi]) - e)
        untold = np.zeros(graphs, bool)
        untold[home[lo[left > 0]]] = True
        # a round of refinement, as in _recoloured
        near = [_added(np.concatenate([a, b]), _mixed(k, *(c[np.concatenate([b, a])] for c in colours)), len(owner)) for k in (1, 2)]
        finer = [_mixed(k, *colours, *near) for k in (3, 4)]
        before, after = (np.bincount(owner[h], minlength=graphs) for h in (head, _cells(owner, finer)[1]))
        going = untold & (after > before)
        tied = left > 0
        tied[tied] = ~going[home[lo[tied]]]
        hard |= _cyclic(home, n, lo[tied], hi[tied], left[tied], graphs)
        done = np.zeros(graphs, bool)
        done[owner] = True
        done &= ~going
        for k, form in enumerate(forms):
            ends = _mixed(5 + k, *(t[lo] for t in tint)) + _mixed(5 + k, *(t[hi] for t in tint))
            whole = _added(home, _mixed(7 + k, *tint, n), graphs) + _added(home[lo], _mixed(9 + k, ends, e), graphs)
            form[done] = whole[done]
        colours = finer


def _settled(most: int, rows_at_once: int):
    """A task over rows ``gid, u, v, c1, c2`` in the order of gid, v and u, nodes with a null v: ``gid, f1, f2, way`` a graph."""
    names = ["gid", "f1", "f2", "way"]

    def settle(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        ends = np.append(starts[1:], len(table))
        number = lambda c: pc.fill_null(table.column(c), 0).to_numpy()
        node, u, v = pc.is_null(table.column("v")).to_numpy(zero_copy_only=False), number("u"), number("v")
        of = np.repeat(np.arange(len(starts)), ends - starts)
        new = node.copy()
        new[1:] &= (u[1:] != u[:-1]) | (of[1:] != of[:-1])
        size = np.bincount(of[new], minlength=len(starts))
        node, link = (rows & (size <= most)[of] for rows in (node, ~node))
        forms, hard = _graph_forms(len(starts), of[node], u[node], [number(c)[node].view(np.uint64) for c in ("c1", "c2")], of[link], u[link], v[link])
        way = np.where(size > most, "columns", np.where(hard, "string", ""))
        some = pa.array(size > 0)
        gid = table.column("gid").take(pa.array(starts)).combine_chunks()
        return pa.RecordBatch.from_arrays([c.filter(some) for c in (gid, *(pa.array(f.view(np.int64)) for f in forms), pa.array(way.tolist(), pa.string()))], names)

    def run(batches):
        held, rows, limit, passed = [], 0, rows_at_once, None
        for batch in batches:
            if passed is not None:
                batch = batch.filter(pc.not_equal(batch.column(0), passed))
            if not len(batch):
                continue
            passed = None
            held, rows = [*held, batch], rows + len(batch)
            if rows < limit:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            starts = _graph_starts(table)
            cut, limit = int(starts[-1]), rows_at_once
            if cut:
                yield settle(table.slice(0, cut), starts[:-1])
            table = table.slice(cut)
            u = table.column("u").filter(pc.is_null(table.column("v")))
            if pc.count_distinct(u, "all").as_py() > most:
                # its further rows are passed over
                yield settle(table, np.zeros(1, np.int64))
                passed, table = table.column("gid")[0], table.slice(len(table))
            held, rows = table.to_batches(), len(table)
            limit = max(limit, 2 * rows)
        if rows:
            table = pa.Table.from_batches(held).combine_chunks()
            yield settle(table, _graph_starts(table))

    return run


def _graph_starts(table: pa.Table) -> np.ndarray:
    gid = table.column("gid")
    return np.concatenate([[0], 1 + np.flatnonzero(pc.not_equal(gid.slice(1), gid.slice(0, len(gid) - 1)).to_numpy())])


def graph_dedup(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``gid, class_id``: graphs equal up to isomorphism share the smallest gid.

    Colours are refined until they part no more nodes of a graph; a graph's form
    is the hashes of its colours with their sizes and of the numbers of links
    between them. The form decides isomorphism where every two colours have all
    links or none (all nodes told apart, or all but twins), and where the links
    between the others, or those missing if they are fewer, are a forest:
    refinement tells forests apart. The first kind takes no further round. Only
    other graphs, and those with loops, get their canonical string in Python.

    Nodes and links meet by graph in one shuffle, after which a task settles
    many graphs of up to ``SMALL_GRAPH`` nodes at once; of a larger one it holds
    no more than that, and ``column_forms`` refines it over the cluster. A class
    is a minimum over equal forms: graphs never meet one another, and a class of
    any size costs rows. Null labels equal empty ones; an edge with an end that
    isn't a node is left out.
    """
    text = lambda c: F.col(c).cast("string")
    whole = {dict(df.dtypes)[c] for df, c in ((nodes, "node"), (edges, "u"), (edges, "v"))} <= {"tinyint", "smallint", "int", "bigint"}
    name = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(-(1 << 63))) if whole else F.xxhash64(text(c))
    none, kind = F.lit(None).cast("long"), dict(nodes.dtypes)["gid"]
    label = F.coalesce(text("label"), F.lit(""))
    rows = nodes.where("gid is not null").select("gid", name("node").alias("u"), none.alias("v"), *(F.xxhash64(F.lit(k), label).alias(f"c{k}") for k in (1, 2)))
    edges = edges.where("gid is not null and u is not null and v is not null")
    links = edges.select(F.col("gid").cast(kind).alias("gid"), name("u").alias("u"), name("v").alias("v"), none.alias("c1"), none.alias("c2"))
    together = rows.unionAll(links).repartition("gid").sortWithinPartitions("gid", "v", "u")
    found = materialize(together.mapInArrow(_settled(SMALL_GRAPH, GRAPH_ROWS), f"gid {kind}, f1 long, f2 long, way string"), "graph-forms")
    forms = [found.where("way = ''").select("gid", "f1", "f2")]
    big, hard = (materialize(found.where(F.col("way") == way).select("gid"), f"{way}-graphs") for way in ("columns", "string"))
    if not big.isEmpty():
        more, tied = column_forms(nodes.join(big, "gid", "left_semi"), edges.join(big, "gid", "left_semi"))
        forms.append(more)
        hard = materialize(hard.unionAll(tied), "string-graphs")
    if not hard.isEmpty():
        labels = nodes.select("gid", text("node").alias("node"), label.alias("label"))
        ends = edges.select("gid", F.least(text("u"), text("v")).alias("u"), F.greatest(text("u"), text("v")).alias("v")).distinct()
        strings = canonical_strings(labels.join(hard, "gid", "left_semi"), ends.join(hard, "gid", "left_semi"))
        forms.append(materialize(strings.select("gid", *(F.xxhash64(F.lit(k), F.lit("s"), "canonical").alias(f"f{k}") for k in (1, 2))), "forms"))
    found = reduce(DataFrame.unionAll, forms)
    firsts = found.groupBy("f1", "f2").agg(F.min("gid").alias("class_id"))
    return found.join(firsts, ["f1", "f2"]).select("gid", "class_id")


def column_forms(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``gid, f1, f2`` of graphs of any size, refined in columns, and ``gid`` of those that need a string; see ``graph_dedup``."""
    text = lambda c: F.col(c).cast("string")
    coded = nodes.where("gid is not null").select("gid", text("node").alias("node"), F.unhex(F.md5(F.coalesce(text("label"), F.lit("")))).alias("colour"))
    state = materialize(coded, "graph-nodes")
    ends = edges.select("gid", F.least(text("u"), text("v")).alias("u"), F.greatest(text("u"), text("v")).alias("v"))
    links = materialize(_coloured(ends, state).distinct(), "graph-links")
    hard = materialize(links.where("u = v").select("gid").distinct(), "looped-graphs")
    if not hard.isEmpty():
        state, links = (df.join(hard, "gid", "left_anti") for df in (state, links))
    forms = []
    sized = lambda df: materialize(df.groupBy("gid", "colour").agg(F.count("*").alias("n")), "cells")
    cells = sized(state)
    while True:
        blocks = materialize(colour_blocks(cells, links), "blocks")
        untold = blocks.where("open > 0").select("gid").distinct()
        counts = materialize(cells.join(untold, "gid", "left_semi").groupBy("gid").agg(F.count("*").alias("k")), "colour-counts")
        later = counts.select("gid")
        if not later.isEmpty():
            state, links = (df.join(later, "gid", "left_semi") for df in (state, links))
            state = materialize(_recoloured(state, links), "colours")
            finer = sized(state)
            growth = counts.join(finer.groupBy("gid").agg(F.count("*").alias("_k")), "gid")
            going = materialize(growth.where("_k > k").select("gid"), "parted-graphs")
            # the others are stable with the colours they had
            stuck = materialize(cyclic_graphs(blocks.join(counts.join(going, "gid", "left_anti"), "gid", "left_semi")), "tied-graphs")
            hard, later = hard.unionAll(stuck), going.unionAll(stuck)
        # rows of one graph differ, so none cancels another
        marks = lambda df, *values: df.select("gid", *(F.xxhash64(F.lit(k), *values).alias(f"f{k}") for k in (1, 2)))
        rows = marks(cells, F.lit("n"), "colour", "n").unionAll(marks(blocks, F.lit("e"), "a", "b", "e"))
        form = rows.groupBy("gid").agg(F.bit_xor("f1").alias("f1"), F.bit_xor("f2").alias("f2"))
        forms.append(materialize(form.join(later, "gid", "left_anti"), "forms"))
        if counts.isEmpty() or going.isEmpty():
            break
        state, links, cells = (df.join(going, "gid", "left_semi") for df in (state, links, finer))
        cells = materialize(cells, "cells")
        links = materialize(_coloured(links, state), "graph-links")
    return reduce(DataFrame.unionAll, forms), hard


def isomorphic_pairs(pairs: DataFrame, nodes: DataFrame, edges: DataFrame, a: str = "gid1", b: str = "gid2") -> DataFrame:
    """``pairs`` with ``same``: whether two graphs are isomorphic; a pair with a graph that has no nodes is null.

    Only the pairs' graphs are classified, and the pairs meet classes, not graphs.
    """
    wanted = pairs.select(F.explode(F.array(a, b)).alias("gid")).distinct()
    classes = materialize(graph_dedup(nodes.join(wanted, "gid", "left_semi"), edges.join(wanted, "gid", "left_semi")), "graph-classes")
    end = lambda c, out: classes.select(F.col("gid").alias(c), F.col("class_id").alias(out))
    joined = pairs.join(end(a, "_x"), a, "left").join(end(b, "_y"), b, "left")
    return joined.select(*pairs.columns, (F.col("_x") == F.col("_y")).alias("same"))


def canonical_form(labels: dict, edges: set) -> str:
    """``(A)(B)…|(i,j)…`` of a graph, the same for every numbering of its nodes.

    Colours are refined; where ties are left, each node of the smallest tied
    group is put first in turn and colours are refined again. The smallest
    trace of group sizes, then the smallest string, wins. Groups of twins (the
    same neighbours) need no choice, and a choice that an automorphism found so
    far maps to an earlier one is left out, which changes no result. In a forest
    an automorphism maps any node of a group to any other, so one choice does.
    """
    edges = {(u, v) for u, v in edges if u in labels and v in labels}
    near = {n: set() for n in labels}
    for u, v in edges:
        near[u].add(v)
        near[v].add(u)

    def refine(colour: dict) -> dict:
        size = len(set(colour.values()))
        while size < len(colour):  # a colour for each node stays as it is
            sign = {n: (c, tuple(sorted(map(colour.__getitem__, near[n])))) for n, c in colour.items()}
            rank = {s: i for i, s in enumerate(sorted(set(sign.values())))}
            colour = {n: rank[s] for n, s in sign.items()}
            if len(rank) == size:
                return colour
            size = len(rank)
        return colour

    def text(order: list) -> str:
        at = {n: i for i, n in enumerate(order)}
        pairs = sorted({(at[u], at[v]) if at[u] < at[v] else (at[v], at[u]) for u, v in edges})
        return "".join(f"({labels[n]})" for n in order) + "|" + "".join(f"({i},{j})" for i, j in pairs)

    def twins(group: list) -> bool:
        n = group[0]
        return all(near[m] == near[n] for m in group) or all(near[m] | {m} == near[n] | {n} for m in group)

    leaves: list[tuple[tuple, str, list, list]] = []  # the first leaf and the best: trace, string, order, path
    same: list[dict] = []  # automorphisms

    def orbit(start: set, path: list) -> set:
        maps = [g for g in same if all(g[n] == n for n in path)]
        found, todo = set(start), list(start)
        while todo:
            n = todo.pop()
            for g in maps:
                if g[n] not in found:
                    found.add(g[n])
                    todo.append(g[n])
        return found

    def walk(colour: dict, path: list, trace: tuple) -> int:
        """The depth to go on from: less than ``len(path)`` if this branch is equal to an earlier one."""
        groups: dict[int, list] = {}
        for n, c in colour.items():
            groups.setdefault(c, []).append(n)
        cells = [groups[c] for c in sorted(groups)]
        trace = (*trace, tuple(len(c) for c in cells))
        if leaves and trace > leaves[-1][0][: len(trace)]:
            return len(path)
        tied = [c for c in cells if len(c) > 1 and not twins(c)]
        if not tied:
            order = [n for c in cells for n in c]
            leaf = (trace, text(order), order, path)
            for other in leaves:
                if other[:2] == leaf[:2]:
                    same.append(dict(zip(order, other[2])))
                    same.append(dict(zip(other[2], order)))
                    return next(i for i, (x, y) in enumerate(zip(path, other[3])) if x != y)
            if not leaves:
                leaves.append(leaf)
            elif leaf[:2] < leaves[-1][:2]:
                leaves[1:] = [leaf]
            return len(path)
        done: set = set()
        for n in min(tied, key=len):
            if done and n in orbit(done, path):
                continue
            done.add(n)
            back = walk(refine({m: (c, m != n) for m, c in colour.items()}), [*path, n], trace)
            if back < len(path):
                return back
            if forest:
                break
        return len(path)

    def acyclic() -> bool:
        seen: set = set()
        for top in near:
            todo = [] if top in seen else [(top, None)]
            while todo:
                n, above = todo.pop()
                if n in seen:
                    return False
                seen.add(n)
                todo += [(m, n) for m in near[n] if m != above]
        return all(n not in near[n] for n in near)

    rank = {x: i for i, x in enumerate(sorted({str(x) for x in labels.values()}))}
    first = refine({n: rank[str(x)] for n, x in labels.items()})
    order = sorted(first, key=first.__getitem__)
    if len(set(first.values())) == len(first) or all(twins(g) for g in (list(g) for _, g in groupby(order, first.__getitem__)) if len(g) > 1):
        return text(order)  # most graphs: nothing to choose
    forest = acyclic()
    limit = sys.getrecursionlimit()
    sys.setrecursionlimit(max(limit, 2 * len(labels) + 1000))
    try:
        walk(first, [], ())
    finally:
        sys.setrecursionlimit(limit)
    return leaves[-1][1]


def canonical_strings(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``gid, canonical``: one string per graph (a branched chain)."""
    ns = nodes.groupBy("gid").agg(F.collect_list(F.struct(F.col("node").cast("string").alias("node"), F.coalesce("label", F.lit("")).alias("label"))).alias("ns"))
    es = edges.groupBy("gid").agg(F.collect_list(F.struct(F.col("u").cast("string").alias("u"), F.col("v").cast("string").alias("v"))).alias("es"))
    whole = ns.join(es, "gid", "left")

    @F.pandas_udf("string")
    def form(n: pd.Series, e: pd.Series) -> pd.Series:
        return pd.Series([canonical_form({x["node"]: x["label"] for x in a}, {(x["u"], x["v"]) for x in (b if b is not None else [])}) for a, b in zip(n, e)])

    return whole.select("gid", form("ns", "es").alias("canonical"))


def split_train_valid(components: DataFrame, categories: list[str], ratio: float = 0.9, least: int = 100) -> DataFrame:
    """``component, split`` from one row a component with a count column per category.

    A component with more edges of a category than validation may keep
    (``min(floor(total * (1 - ratio)), least)``) goes to training. The others are
    taken for training smallest first (then by component) while every category
    keeps that number for validation. Each component is visited once.

    The free components are range-partitioned in that order. As long as what
    fits of the next partitions fits altogether, these are settled at once from
    sums; only the partition in which a category runs out is walked row by row.
    A category's room falls below the count that didn't fit, so there are at
    most ``least * len(categories)`` such partitions, and never more than there
    are partitions. Null counts are zero; an empty table gives an empty split.
    """
    counts = components.select("component", *(F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in categories))
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in categories]
    totals = counts.agg(*sums).first()
    keep = {c: min(int(totals[c] * (1 - ratio) + 1e-9), least) for c in categories}
    must = reduce(or_, (F.col(c) > keep[c] for c in categories))
    taken = counts.where(must).agg(*sums).first()
    room = {c: totals[c] - taken[c] - keep[c] for c in categories}
    kind = dict(components.dtypes)["component"]
    ordered = counts.where(~must).withColumn("_n", reduce(add, (F.col(c) for c in categories)))
    free = materialize(ordered.repartitionByRange("_n", "component").withColumn("_part", F.spark_partition_id()), "free")

    def walk(start: dict[str, int]):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            left, out = dict(start), []
            for r in pdf.sort_values(["_n", "component"]).to_dict("records"):
                ok = all(r[c] <= left[c] for c in categories)
                if ok:
                    left = {c: left[c] - r[c] for c in categories}
                out.append((r["component"], "train" if ok else "valid", *(r[c] for c in categories)))
            return pd.DataFrame(out, columns=["component", "split", *categories])

        return run

    settled: list[tuple] = []  # partitions in which all that fits goes to training
    walked: list[DataFrame] = []
    start = 0
    while True:
        fits = reduce(and_, (F.col(c) <= room[c] for c in categories))
        # a row a partition
        parts = free.where(F.col("_part") >= start).groupBy("_part").agg(*(F.sum(F.when(fits, F.col(c)).otherwise(0)).alias(c) for c in categories)).orderBy("_part").collect()
        begin, full, spent = dict(room), None, dict.fromkeys(categories, 0)
        for p in parts:
            upto = {c: spent[c] + p[c] for c in categories}
            if any(p[c] and upto[c] > begin[c] for c in categories):
                full = p["_part"]
                break
            spent = upto
            settled.append((p["_part"], *(begin[c] for c in categories)))
        room = {c: begin[c] - spent[c] for c in categories}
        if full is None:
            break
        schema = f"component {kind}, split string, " + ", ".join(f"`{c}` long" for c in categories)
        rows = materialize(free.where(F.col("_part") == full).groupBy("_part").applyInPandas(walk(room), schema), "walked")
        used = rows.where("split = 'train'").agg(*sums).first()
        room = {c: room[c] - used[c] for c in categories}
        walked.append(rows.select("component", "split"))
        start = full + 1
    names = [f"_room{i}" for i in range(len(categories))]
    plan = components.sparkSession.createDataFrame(settled, "_part int, " + ", ".join(f"{n} long" for n in names))
    taken_whole = reduce(and_, (F.col(c) <= F.col(n) for c, n in zip(categories, names)))
    out = counts.where(must).select("component", F.lit("train").alias("split"))
    for more in [free.join(F.broadcast(plan), "_part").select("component", F.when(taken_whole, "train").otherwise("valid").alias("split")), *walked]:
        out = out.unionByName(more)
    return out
