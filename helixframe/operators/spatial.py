"""Radius joins on a grid, contact counts and affine copies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixframe.session import materialize


#: Points of a cell above which it is parted, and parts a side at most.
DENSE, MOST_PARTS = 4096, 16


def neighbours(points: DataFrame, radius: float, group: list[str], idx: str, xyz: tuple[str, str, str] = ("x", "y", "z"),
               most: int | None = None, dense: int = DENSE) -> DataFrame:
    """Directed neighbour rows ``group..., i, j`` with distance at most ``radius``.

    The grid cell is an equi-join key: one side is repeated for its 27
    neighbouring cells, the other keeps its own, so no pair outside adjacent
    cells is formed and a group's points never meet another group's. A cell with
    more than ``dense`` points is parted into sub-cells; a point goes to those
    of them that its radius reaches, so a crowded cell spreads over tasks. With
    ``most`` every point keeps its neighbours of lowest index. Points without a
    complete coordinate have no neighbours.
    """
    x, y, z = xyz
    whole = points.where(" and ".join(f"`{c}` is not null" for c in xyz))
    cell = [F.floor(F.col(c) / radius).cast("long") for c in xyz]
    own = whole.select(*group, F.col(idx).alias("i"), *(F.col(c).alias(f"_a{k}") for k, c in enumerate(xyz)), *(c.alias(f"_c{k}") for k, c in enumerate(cell)))
    other = whole.select(*group, F.col(idx).alias("j"), *(F.col(c).alias(f"_b{k}") for k, c in enumerate(xyz)), *(c.alias(f"_c{k}") for k, c in enumerate(cell)))
    keys = [*group, "_c0", "_c1", "_c2"]
    crowded = materialize(other.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > dense), "crowded-cells")
    step = F.array(F.lit(-1), F.lit(0), F.lit(1))
    for k in range(3):
        own = own.withColumn("_s", F.explode(step)).withColumn(f"_c{k}", F.col(f"_c{k}") + F.col("_s")).drop("_s")
    if not crowded.isEmpty():
        parts = crowded.select(*keys, F.least(F.lit(MOST_PARTS), F.ceil(F.cbrt(F.col("_n") / dense))).cast("int").alias("_f"))
        own, other = (df.join(parts, keys, "left").withColumn("_f", F.coalesce("_f", F.lit(1))) for df in (own, other))
        # a place within the cell in sub-cells, held within it; one sub-cell to spare on both sides for rounding
        place = lambda c, k, shift: F.floor((F.col(c) + shift - F.col(f"_c{k}") * radius) / radius * F.col("_f"))
        held = lambda c: F.greatest(F.lit(0), F.least(F.col("_f") - 1, c)).cast("int")
        for k in range(3):
            other = other.withColumn(f"_p{k}", held(place(f"_b{k}", k, F.lit(0.0))))
            own = own.withColumn(f"_p{k}", F.explode(F.sequence(held(place(f"_a{k}", k, F.lit(-radius)) - 1), held(place(f"_a{k}", k, F.lit(radius)) + 1))))
        own, other, keys = own.drop("_f"), other.drop("_f"), [*keys, "_p0", "_p1", "_p2"]
    distance = sum(((F.col(f"_a{k}") - F.col(f"_b{k}")) * (F.col(f"_a{k}") - F.col(f"_b{k}")) for k in range(3)), F.lit(0.0))
    pairs = own.join(other, keys).where((F.col("i") != F.col("j")) & (distance <= radius * radius)).select(*group, "i", "j")
    if most is None:
        return pairs
    w = Window.partitionBy(*group, "i").orderBy("j")
    return pairs.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= most).drop("_r")


def neighbour_counts(pairs: DataFrame, group: list[str]) -> DataFrame:
    return pairs.groupBy(*group, "i").agg(F.count(F.lit(1)).alias("n"))


def contact_graph(points: DataFrame, radius: float, group: list[str], idx: str, chain: str,
                  xyz: tuple[str, str, str] = ("x", "y", "z"), most: int | None = 128, undirected: bool = False) -> DataFrame:
    """``group..., src, dst, n``: contacts of every pair of chains, ``src < dst``.

    Both directions of a contact count unless ``undirected``; the cap is spent
    on neighbours in the own chain too.
    """
    pairs = neighbours(points, radius, group, idx, xyz, most)
    of = points.select(*group, F.col(idx).alias("_i"), F.col(chain).alias("_chain"))
    a = of.select(*group, F.col("_i").alias("i"), F.col("_chain").alias("_ca"))
    b = of.select(*group, F.col("_i").alias("j"), F.col("_chain").alias("_cb"))
    crossing = pairs.join(a, [*group, "i"]).join(b, [*group, "j"]).where("_ca <> _cb")
    n = F.count(F.lit(1))
    return crossing.groupBy(*group, F.least("_ca", "_cb").alias("src"), F.greatest("_ca", "_cb").alias("dst")).agg(
        (F.floor(n / 2) if undirected else n).cast("long").alias("n"))


def apply_operators(points: DataFrame, operators: DataFrame, keys: list[str], xyz: tuple[str, str, str] = ("x", "y", "z")) -> DataFrame:
    """Every point under every operator of its key: ``p' = M p + v``.

    ``operators`` has ``oper_id`` (which may be one of the keys), ``m11..m33``
    and ``v1..v3``; a null coordinate stays null.
    """
    return moved_points(points.join(operators, keys), points.columns, xyz)


def moved_points(joined: DataFrame, columns: list[str], xyz: tuple[str, str, str] = ("x", "y", "z")) -> DataFrame:
    """``columns`` of points that have their operator's columns, with the points moved."""
    x, y, z = (F.col(c) for c in xyz)
    out = [(F.col(f"m{r}1") * x + F.col(f"m{r}2") * y + F.col(f"m{r}3") * z + F.col(f"v{r}")).alias(c) for r, c in zip((1, 2, 3), xyz)]
    return joined.select(*(c for c in columns if c not in xyz and c != "oper_id"), "oper_id", *out)
