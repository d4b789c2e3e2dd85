"""Multiple-sequence-alignment features: rows, deletions, profiles, headers and row selection."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType
from pyspark.sql.window import Window

from helixframe.functions.codes import GAP_INDEX, PROFILE_BINS, RNA_INDEX, lookup, protein_index
from helixframe.operators.sequences import global_rank
from helixframe.session import materialize


def aligned(row: Column) -> Column:
    """The row without its insertions (lower-case letters)."""
    return F.regexp_replace(row, "[a-z]", "")


def deletions(row: Column) -> Column:
    """Inserted letters before every match column, at most 255; trailing insertions are ignored."""
    runs = F.regexp_extract_all(row, F.lit("([a-z]*)([^a-z])"), F.lit(1))
    return F.transform(runs, lambda r: F.least(F.length(r), F.lit(255)))


def letters(row: Column) -> Column:
    """The characters of a string; none for an empty one."""
    return F.filter(F.split(row, ""), lambda c: c != "")


def encode(row: Column, kind: str = "protein") -> Column:
    """Profile index of every aligned letter; unknown letters get the kind's unknown index."""
    if kind not in ("protein", "rna"):
        raise ValueError(f"no encoding for {kind}")
    table, unknown = (protein_index(), 20) if kind == "protein" else (RNA_INDEX, RNA_INDEX["N"])
    return F.transform(letters(aligned(row)), lambda c: lookup(table, c, unknown))


def positions(rows: DataFrame, msa: str, row: str, kind: str = "protein") -> DataFrame:
    """``msa, pos, idx, deletion``: one row per aligned letter."""
    zipped = F.arrays_zip(encode(F.col(row), kind).alias("idx"), deletions(F.col(row)).alias("deletion"))
    both = rows.select(F.col(msa).alias("msa"), F.posexplode(zipped).alias("pos", "z"))
    return both.select("msa", "pos", F.col("z.idx").alias("idx"), F.col("z.deletion").alias("deletion"))


def deletion_mean(cells: DataFrame) -> DataFrame:
    return cells.groupBy("msa", "pos").agg(F.avg(F.atan(F.col("deletion") / 3) * F.lit(2 / np.pi)).alias("deletion_mean"))


def profile_counts(cells: DataFrame) -> DataFrame:
    """``msa, pos, idx, frequency`` of the bins that occur; frequencies of a position sum to 1."""
    counted = cells.groupBy("msa", "pos", "idx").agg(F.count(F.lit(1)).alias("n"))
    depth = cells.groupBy("msa", "pos").agg(F.count(F.lit(1)).alias("depth"))
    return counted.join(depth.hint("merge"), ["msa", "pos"]).select("msa", "pos", "idx", (F.col("n") / F.col("depth")).alias("frequency"))


#: Cells of count matrices that a task holds before it hands them on.
HELD_CELLS = 1 << 21


def profile_matrices(rows: DataFrame, msa: str, row: str, kind: str = "protein") -> DataFrame:
    """``msa, pos, depth, counts, deletion_mean``: letters of each bin at each position.

    A task adds up a matrix of positions and bins an alignment and hands it on
    once its matrices fill the bound, so what is shuffled are positions times
    tasks, not letters. Rows of one alignment may differ in length; null rows
    count for nothing.
    """
    if kind not in ("protein", "rna"):
        raise ValueError(f"no encoding for {kind}")
    table, unknown = (protein_index(), 20) if kind == "protein" else (RNA_INDEX, RNA_INDEX["N"])
    name = dict(rows.dtypes)[msa]
    code = np.full(1 << 16, unknown, np.int64)
    for letter, i in table.items():
        code[ord(letter)] = i

    def run(batches):
        held: dict = {}

        def flush():
            keys, places, counts, sums = [], [], [], []
            for k, (m, d) in held.items():
                keys += [k] * len(m)
                places.append(np.arange(len(m)))
                counts.append(m)
                sums.append(d)
            held.clear()
            flat = np.concatenate(counts) if counts else np.zeros((0, PROFILE_BINS), np.int64)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(flat.ravel()), PROFILE_BINS).cast(pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(keys, kinds), pa.array(np.concatenate(places) if places else np.zeros(0), pa.int64()), lists,
                                               pa.array(np.concatenate(sums) if sums else np.zeros(0), pa.float64())], ["msa", "pos", "counts", "deletions"])

        for batch in batches:
            kinds = batch.schema.field(0).type
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text is None:
                    continue
                chars = np.frombuffer(text.encode("utf-32-le"), np.uint32)
                low = (chars >= 97) & (chars <= 122)
                at = np.flatnonzero(~low)
                n = len(at)
                m, d = held.get(k, (np.zeros((0, PROFILE_BINS), np.int64), np.zeros(0)))
                if len(m) < n:
                    m, d = np.vstack([m, np.zeros((n - len(m), PROFILE_BINS), np.int64)]), np.append(d, np.zeros(n - len(d)))
                m[np.arange(n), code[np.minimum(chars[at], (1 << 16) - 1)]] += 1
                d[:n] += np.arctan(np.minimum(np.diff(at, prepend=-1) - 1, 255) / 3) * (2 / np.pi)
                held[k] = (m, d)
            if sum(len(m) for m, _ in held.values()) * PROFILE_BINS >= HELD_CELLS:
                yield flush()
        if held:
            yield flush()

    parts = rows.select(F.col(msa).alias("msa"), F.col(row).alias("row")).mapInArrow(run, f"msa {name}, pos long, counts array<bigint>, deletions double")
    counts = F.array(*(F.sum(F.col("counts")[i]) for i in range(PROFILE_BINS)))
    whole = parts.groupBy("msa", "pos").agg(counts.alias("counts"), F.sum("deletions").alias("_d"))
    return whole.withColumn("depth", F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b)).select("msa", "pos", "depth", "counts", (F.col("_d") / F.col("depth")).alias("deletion_mean"))


def profile_rows(matrices: DataFrame) -> DataFrame:
    """``msa, pos, idx, frequency, deletion_mean`` of the bins that occur."""
    each = matrices.select("msa", "pos", "depth", "deletion_mean", F.posexplode("counts").alias("idx", "n")).where("n > 0")
    return each.select("msa", "pos", "idx", (F.col("n") / F.col("depth")).alias("frequency"), "deletion_mean")


def dense_profile(counts: DataFrame) -> DataFrame:
    """``msa, pos, profile``: all bins as an array."""
    table = counts.groupBy("msa", "pos").agg(F.map_from_entries(F.collect_list(F.struct("idx", "frequency"))).alias("_m"))
    return table.select("msa", "pos", F.transform(F.sequence(F.lit(0), F.lit(PROFILE_BINS - 1)),
                                                  lambda i: F.coalesce(F.element_at("_m", i), F.lit(0.0)).cast("float")).alias("profile"))


def header_fields(df: DataFrame, header: str, order: str) -> DataFrame:
    """``database, database_id, species, rep_id`` of every header; row 0 is the query.

    UniRef style, then UniProt pipe style, else the first token as a bfd entry;
    a leading ``>`` is optional and nothing carries over between headers.
    """
    h = F.regexp_replace(F.coalesce(header, F.lit("")), "^>", "")
    uniref = r"^(UniRef\d+)_(\S+)\s.*?Tax=(.+?)\s+TaxID=\S+\s+RepID=(\S+)"
    pipe = r"^(tr|sp)\|([^|]+)\|(\S+)\s.*?OS=(.+?)\s+OX="
    token = F.regexp_extract(h, r"^(\S*)", 1)
    is_ref, is_pipe, query = F.rlike(h, F.lit(uniref)), F.rlike(h, F.lit(pipe)), F.col(order) == 0

    def field(ref: Column, pip: Column, other: Column) -> Column:
        return F.when(query, "query").when(is_ref, ref).when(is_pipe, pip).otherwise(other)

    g = F.regexp_extract
    return df.withColumns({
        "database": field(F.lower(g(h, uniref, 1)), g(h, pipe, 1), F.lit("bfd")),
        "database_id": field(g(h, uniref, 2), g(h, pipe, 2), token),
        "species": field(g(h, uniref, 3), g(h, pipe, 4), F.lit("N/A")),
        "rep_id": field(g(h, uniref, 4), g(h, pipe, 3), token),
    })


def gap_fraction(row: Column) -> Column:
    whole = aligned(row)
    return (F.length(whole) - F.length(F.replace(whole, F.lit("-"), F.lit("")))) / F.greatest(F.length(whole), F.lit(1))


def cap_depth(rows: DataFrame, msa: str, row: str, order: str, most: int = 16384) -> DataFrame:
    """The ``most`` least-gapped rows of every alignment, ties by row order."""
    w = Window.partitionBy(msa).orderBy(gap_fraction(F.col(row)), order)
    return rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= most).drop("_r")


def coverage(row: Column) -> Column:
    return F.lit(1.0) - gap_fraction(row)


def _cells(texts) -> np.ndarray:
    """Rows of characters, filled with gaps to one width."""
    width = max(map(len, texts), default=0)
    return np.frombuffer("".join(t.ljust(width, "-") for t in texts).encode("latin-1", "replace"), np.uint8).reshape(len(texts), width)


def _like(row: np.ndarray, others: np.ndarray, most_identity: float) -> np.ndarray:
    """Which of the others a row is more like than allowed, over columns where both have a letter."""
    both = (others != ord("-")) & (row != ord("-"))
    same = ((others == row) & both).sum(1)
    return same > most_identity * np.maximum(both.sum(1), 1)


def _paired(frame: DataFrame, earlier: DataFrame) -> DataFrame:
    """Rows beside every earlier or equal block of their alignment: ``gid, e, b, at, a, known``; known rows are block ``e``'s."""
    blocks = earlier.select("gid", F.col("b").alias("e")).distinct()
    later = frame.join(blocks, "gid").where("e <= b").select("gid", "e", "b", "at", "a", F.lit(False).alias("known"))
    pairs = frame.select("gid", "b").distinct().join(blocks, "gid").where("e <= b")
    known = earlier.withColumnRenamed("b", "e").join(pairs, ["gid", "e"]).select("gid", "e", "b", "at", "a", F.lit(True).alias("known"))
    return later.unionByName(known)


def _linked(width: int, most_identity: float):
    """For each row of a block, as a bit row, the rows of another (or, before it, of its own) that it is too like."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        known, own = pdf["known"].to_numpy(bool), pdf["e"].iloc[0] == pdf["b"].iloc[0]
        cells, at = _cells(pdf["a"].tolist()), pdf["at"].to_numpy()
        others, places = cells[known], at[known]
        out = []
        for i in np.flatnonzero(~known):
            like = _like(cells[i], others, most_identity)
            if own:
                like &= places < at[i]
            if like.any():
                bits = np.zeros(width * 8, bool)
                bits[places[like]] = True
                out.append((pdf["gid"].iloc[0], pdf["e"].iloc[0], pdf["b"].iloc[0], at[i], np.packbits(bits).tobytes()))
        return pd.DataFrame(out, columns=["gid", "e", "b", "at", "bits"])

    return run


def _overruled(most_identity: float):
    """Rows of a block that are too like a kept row of an earlier one."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        known = pdf["known"].to_numpy(bool)
        cells = _cells(pdf["a"].tolist())
        gone = [i for i in np.flatnonzero(~known) if _like(cells[i], cells[known], most_identity).any()]
        return pdf.iloc[gone][["gid", "b", "at"]]

    return run


def _settled(width: int):
    """One block's rows as far as the earlier blocks allow: kept, still open, or neither."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        state = pdf[pdf["code"].isna()].iloc[0]
        kept, open_ = (np.unpackbits(np.frombuffer(state[c], np.uint8)).astype(bool) for c in ("kept", "open"))
        code = np.zeros(width * 8, np.int8)
        links: dict[int, np.ndarray] = {}
        marks = pdf.loc[pdf["code"].notna(), ["at", "code", "bits"]].astype({"at": int, "code": int})
        for at, c, bits in marks.itertuples(index=False):
            if bits is None:
                code[at] = max(code[at], c)
            else:
                links[at] = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
        for i in np.flatnonzero(open_):
            own = links.get(i)
            if code[i] == 2 or own is not None and (own & kept).any():
                open_[i] = False
            elif code[i] == 0 and (own is None or not (own & open_).any()):
                kept[i], open_[i] = True, False
        return pd.DataFrame({"gid": [state["gid"]], "b": [state["b"]], "kept": [np.packbits(kept).tobytes()], "open": [np.packbits(open_).tobytes()], "n_open": [int(open_.sum())]})

    return run


_STATE = "gid long, b long, kept binary, open binary, n_open long"


def _first_state(width: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(width * 8, bool)
        bits[pdf["at"].to_numpy()] = True
        none = np.zeros(width, np.uint8).tobytes()
        return pd.DataFrame({"gid": [pdf["gid"].iloc[0]], "b": [pdf["b"].iloc[0]], "kept": [none], "open": [np.packbits(bits).tobytes()], "n_open": [len(pdf)]})

    return run


@F.pandas_udf(IntegerType())
def _meets(bits: pd.Series, kept: pd.Series, open_: pd.Series) -> pd.Series:
    """2 where a bit row meets kept rows, else 1 where it meets open ones, else 0."""
    if not len(bits):
        return pd.Series([], dtype="int32")
    rows, k, o = (np.frombuffer(b"".join(c), np.uint8).reshape(len(bits), -1) for c in (bits, kept, open_))
    return pd.Series(np.where((rows & k).any(1), 2, np.where((rows & o).any(1), 1, 0)).astype("int32"))


def _kept_places(batches):
    for pdf in batches:
        rows = [(g, b, int(i)) for g, b, kept in pdf[["gid", "b", "kept"]].itertuples(index=False)
                for i in np.flatnonzero(np.unpackbits(np.frombuffer(kept, np.uint8)))]
        yield pd.DataFrame(rows, columns=["gid", "b", "at"])


def _walk_window(now: DataFrame, width: int, most_identity: float) -> DataFrame:
    """``gid, b, at`` of the rows of a window that the walk in row order keeps.

    Every two blocks meet once, each pair in a task; a round then settles all
    rows whose earlier like rows are settled. The first block with open rows is
    always settled whole, so there are no more rounds than blocks; mostly there
    are two or three.
    """
    links = materialize(_paired(now, now).groupBy("gid", "e", "b").applyInPandas(_linked(width, most_identity), "gid long, e long, b long, at int, bits binary"), "msa-links")
    state = materialize(now.select("gid", "b", "at").groupBy("gid", "b").applyInPandas(_first_state(width), _STATE), "msa-state")
    while True:
        busy = state.where("n_open > 0")
        held = links.join(busy.select("gid", "b"), ["gid", "b"], "left_semi")
        before = state.select("gid", F.col("b").alias("e"), "kept", "open")
        none = F.lit(None).cast("binary")
        outer = held.where("e < b").join(before, ["gid", "e"]).select("gid", "b", "at", _meets("bits", "kept", "open").alias("code"))
        outer = outer.groupBy("gid", "b", "at").agg(F.max("code").alias("code")).where("code > 0")
        parts = busy.select("gid", "b", "kept", "open", F.lit(None).cast("int").alias("at"), F.lit(None).cast("int").alias("code"), none.alias("bits"))
        parts = parts.unionByName(outer.select("gid", "b", none.alias("kept"), none.alias("open"), "at", "code", none.alias("bits")))
        parts = parts.unionByName(held.where("e = b").select("gid", "b", none.alias("kept"), none.alias("open"), "at", F.lit(0).alias("code"), "bits"))
        settled = parts.groupBy("gid", "b").applyInPandas(_settled(width), _STATE)
        state = materialize(state.where("n_open = 0").unionByName(settled), "msa-state")
        if not state.agg(F.sum("n_open")).first()[0]:
            return state.select("gid", "b", "kept").mapInPandas(_kept_places, "gid long, b long, at int")


def drop_redundant(rows: DataFrame, msa: str, row: str, order: str, least_coverage: float, most_identity: float = 0.9, block: int = 2048) -> DataFrame:
    """Rows of enough coverage that are at most ``most_identity`` like every row kept before.

    An alignment's rows are walked in row order (ties by the row), in windows of
    1, 3, 12, 48, ... blocks: a window is settled, then every later row is held
    against what it keeps, one task for each two blocks. So the windows grow with
    the logarithm of the depth, no task holds more than two blocks, and only
    rows still standing move on. Likeness within a window is kept as bit rows
    (``block`` / 8 bytes for a row and a block with like rows), about as much as
    the comparison itself shuffles, or less.

    A row equal to an earlier one goes at once: whatever keeps or drops that one
    drops it. A null alignment name is an alignment of its own; null rows are
    left out, empty ones are like no other row.
    """
    packed = rows.where(coverage(F.col(row)) >= least_coverage).select(
        F.col(msa).alias("k"), F.col(order).alias("o"), aligned(F.col(row)).alias("a"), F.struct(*rows.columns).alias("row"))
    ranked = materialize(global_rank(packed, ["k", "o", "a"], "rank"), "msa-rows")
    heads = ranked.groupBy("k").agg(F.min("rank").alias("gid")).withColumnRenamed("k", "_k")
    todo = ranked.join(heads, F.col("k").eqNullSafe(F.col("_k"))).select("gid", "rank", "a")
    if 0 <= most_identity < 1:
        # rows without a letter are like none
        alone = F.when(F.rlike("a", F.lit("[^-]")), F.lit(-1)).otherwise(F.col("rank"))
        todo = todo.groupBy("gid", "a", alone).agg(F.min("rank").alias("rank")).select("gid", "rank", "a")
    place = F.col("rank") - F.col("gid")
    todo = todo.select("gid", F.floor(place / block).cast("long").alias("b"), (place % block).cast("int").alias("at"), "a")
    todo = materialize(todo, "msa-todo")
    width, high, chosen = -(-block // 8), 1, []
    while not todo.isEmpty():
        now, later = todo.where(F.col("b") < high), todo.where(F.col("b") >= high)
        places = materialize(_walk_window(now, width, most_identity), "msa-kept")
        chosen.append(places)
        if later.isEmpty():
            break
        kept = now.join(places, ["gid", "b", "at"], "left_semi")
        gone = _paired(later, kept).groupBy("gid", "e", "b").applyInPandas(_overruled(most_identity), "gid long, b long, at int").distinct()
        todo = materialize(later.join(gone, ["gid", "b", "at"], "left_anti"), "msa-todo")
        high *= 4
    ranks = reduce(DataFrame.unionByName, chosen, todo.select("gid", "b", "at").limit(0)).select((F.col("gid") + F.col("b") * block + F.col("at")).alias("rank"))
    return ranked.join(ranks, "rank", "left_semi").select("row.*")


def choose_tier(counts: DataFrame, key: str, tier: str, n75: str, n50: str, least75: int = 2000, least50: int = 4000) -> DataFrame:
    """``key, tier, choice``: the first tier that is deep enough at 75 % coverage, else at 50 %.

    Keys none of whose tiers is deep enough get the last tier's 50 % rows.
    """
    choice = F.when(F.col(n75) > least75, "cov75").when(F.col(n50) > least50, "cov50")
    marked = counts.withColumn("_c", choice)
    return marked.groupBy(key).agg(
        F.coalesce(F.min(F.when(F.col("_c").isNotNull(), F.col(tier))), F.max(tier)).alias(tier),
        F.coalesce(F.min_by("_c", F.when(F.col("_c").isNotNull(), F.col(tier))), F.lit("fallback")).alias("choice"))
