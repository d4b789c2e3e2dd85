"""Sequence clustering in linear rows: members meet centres, never each other.

``linked_centres`` seeks links from sequences to centres: every sequence is
represented by its minimisers (the k-mer of least rank in each window), each
k-mer's group has its longest sequence for a centre, and a member votes for the
centre's diagonal. Pairs with enough votes are aligned in a band around their
best diagonal; sequences are fetched for these pairs only.

``greedy_bands`` is longest-first greedy clustering: bands of the length order
are settled one after the other against an index of the representatives so far
(rare words of each, as many as a pair within the identity must share one of).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixframe.operators.cluster import align_counts
from helixframe.operators.sequences import global_rank
from helixframe.session import materialize, scratch

#: Ranks of k-mers: a multiplicative generator modulo a prime; any fixed pair would do.
FACTOR, PRIME = 48271, (1 << 31) - 1
#: Letters have six bits in a k-mer's code.
BITS = 6


def kmer_codes(text: str, k: int) -> np.ndarray:
    """A code of every k-mer (k up to 10); letters count modulo 64."""
    letters = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64) & 63
    n = len(letters) - k + 1
    out = np.zeros(max(n, 0), np.int64)
    for i in range(k if n > 0 else 0):
        out = (out << BITS) | letters[i : n + i]
    return out


#: Letters whose minimisers are sought together.
TOGETHER = 1 << 16


def minimisers_of(texts: list[str], k: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the text, code and place of every text's minimisers, by number and code; a code of a text where it comes first."""
    codes, sizes = kmer_codes("".join(texts), k), np.array([len(s) for s in texts], np.int64)
    row = np.repeat(np.arange(len(texts)), np.maximum(sizes - k + 1, 0))
    begin, first = np.cumsum(sizes) - sizes, np.searchsorted(row, np.arange(len(texts)))
    place = np.arange(len(row)) - first[row]
    codes = codes[begin[row] + place] if len(row) else np.zeros(0, np.int64)
    if window > 1 and len(row):
        # rank above code in one number: codes of one rank differ by multiples of PRIME; the first of equal ones counts
        keys = ((codes % PRIME) * FACTOR % PRIME << 29) | codes // PRIME
        many = np.maximum(sizes - k + 1, 0)
        parts = []
        if len(keys) >= window:
            at = np.flatnonzero(row[: len(row) - window + 1] == row[window - 1 :])
            parts.append(at + np.lib.stride_tricks.sliding_window_view(keys, window).argmin(1)[at])
        for r in np.flatnonzero((many > 0) & (many < window)):  # a text of one window
            parts.append(first[r : r + 1] + keys[first[r] : first[r] + many[r]].argmin())
        at = np.unique(np.concatenate(parts))
        row, codes, place = row[at], codes[at], place[at]
    order = np.lexsort((codes, row))  # stable: places stay in order
    row, codes, place = row[order], codes[order], place[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (codes[1:] != codes[:-1])
    return row[new], codes[new], place[new]


def minimisers(seqs: DataFrame, key: str, sequence: str, k: int = 10, window: int = 10) -> DataFrame:
    """``id, word, at, length``: about ``2 / (window + 1)`` rows a letter; a word of a sequence once, where it comes first."""
    kind = dict(seqs.dtypes)[key]

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            ends, at = np.cumsum([0] + [len(s) for s in texts]), 0
            while at < len(texts):
                to = max(at + 1, int(np.searchsorted(ends, ends[at] + TOGETHER, "right")) - 1)
                row, words, places = minimisers_of(texts[at:to], k, window)
                row, at = row + at, to
                flat = lambda each: pa.array(each, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(flat(row)), flat(words), flat(places), flat(np.diff(ends)[row])], ["id", "word", "at", "length"])

    return seqs.where(F.col(sequence).isNotNull()).select(F.col(key).alias("id"), F.col(sequence).alias("s")).mapInArrow(run, f"id {kind}, word long, at long, length long")


def centre_pairs(words: DataFrame, cover: float, least_votes: int = 1) -> DataFrame:
    """``id, centre, diagonal, votes``: each member with the centres of its words, on the diagonal with most votes.

    A word's centre is its longest sequence (ties: the smallest id), so a word
    in ``n`` sequences makes ``n - 1`` pairs. Centres of lengths that can't
    reach ``cover`` are left out. ``diagonal`` is the member's place less the
    centre's.
    """
    longest = F.min_by(F.struct("id", "at", "length"), F.struct((-F.col("length")).alias("n"), "id"))
    centres = words.groupBy("word").agg(longest.alias("c"), F.count("*").alias("n")).where("n > 1").select(
        "word", F.col("c.id").alias("centre"), F.col("c.at").alias("there"), F.col("c.length").alias("most"))
    met = words.join(centres, "word").where((F.col("id") != F.col("centre")) & (F.col("length") >= cover * F.col("most")))
    votes = met.groupBy("id", "centre", (F.col("at") - F.col("there")).alias("diagonal")).agg(F.count("*").alias("votes"))
    best = F.max_by("diagonal", F.struct("votes", (-F.abs("diagonal")).alias("near"), "diagonal"))
    return votes.groupBy("id", "centre").agg(best.alias("diagonal"), F.sum("votes").alias("votes")).where(F.col("votes") >= least_votes)


#: Scores, and the parts of a packed cell: the score above the matches above the columns.
MATCH, MISMATCH, GAP = 2, -1, -3
_SCORE, _MATCHES = 42, 21
_LOW = -(1 << 61)


#: Letters of a side that are laid out together, and rows after which cells are set down again.
LAID_OUT, LIFTED = 1 << 23, 1 << 14


def banded_counts(xs: list[str], ys: list[str], diagonals: list[int], band: int = 16, batch: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Matches and columns of the best alignment of each pair within ``band`` of its diagonal (place in x less place in y).

    Ends may hang over at no cost; of equal scores the one with more matches,
    then more columns counts. A cell packs score, matches and columns into one
    number, so one maximum carries all three. Sequences up to two million letters.

    Pairs step through their rows together, a place of the band in one stretch
    of memory. Rows in which a pair's band doesn't reach its y are left out.
    Cells beyond y's end are no source of those within, so they are only passed
    over where an alignment may end.
    """
    xs, ys = ([np.frombuffer((s or "").encode("utf-32-le"), np.uint32) for s in side] for side in (xs, ys))
    out = np.zeros(len(xs), np.int64)
    width = 2 * band + 1
    lx, ly = (np.array([len(s) for s in side], np.int64) for side in (xs, ys))
    shift = band + np.array(diagonals, np.int64).reshape(len(xs))  # cell b of row i: i letters of x against j = i + b - shift letters of y
    begin = np.maximum(shift - width + 1, 0)
    rows = np.minimum(lx, ly + shift) - begin
    order = np.argsort(rows, kind="stable")
    order = order[rows[order] > 0]
    gap = np.int64(GAP) << _SCORE
    hit, miss = (np.int64(MATCH) << _SCORE) + (1 << _MATCHES) + 1 - 2 * gap, (np.int64(MISMATCH) << _SCORE) + 1 - 2 * gap
    # a cell is kept less the gap for every letter behind it: gaps in a row are then a running maximum, those in a column a
    # plain one. The part of the rows is taken off again every so often, as a score has 21 bits.
    tilt = (np.arange(width) * gap)[:, None]
    offset, at = np.arange(width)[:, None], 0
    while at < len(order):
        part = order[at : at + batch]
        few = np.flatnonzero((np.arange(len(part)) + 1) * (rows[part] + width) > LAID_OUT)
        part = part[: max(1, int(few[0]))] if len(few) else part
        at += len(part)
        count, n = rows[part], int(rows[part[-1]])
        ends, full, past = lx[part] - begin[part], ly[part], shift[part] - begin[part]
        x = np.zeros((n, len(part)), np.uint32)
        # y is laid out so that row i sees its band at places i - 1 to i - 1 + 2 * band
        y = np.full((n + width, len(part)), 0xFFFFFFFF, np.uint32)
        for r, p in enumerate(part):
            x[: count[r], r] = xs[p][begin[p] : begin[p] + count[r]]
            a, b = max(0, -int(past[r])), min(int(full[r]), len(y) - int(past[r]))
            if a < b:
                y[a + past[r] : b + past[r], r] = ys[p][a:b]
        cells = np.where(offset >= past, -tilt, _LOW)
        new, lifted = np.empty_like(cells), 0
        best = np.zeros(len(part), np.int64)
        last = full + past  # the row in which the band's first cell stands at y's end
        # pairs are in order of their rows: the first that is not through, and the first whose end is far
        live = np.searchsorted(count, np.arange(n + 1)).tolist()
        near = np.searchsorted(count, np.arange(n + 1) + width).tolist()
        base = 0
        for i in range(1, n + 1):
            cut = live[i] - base
            if cut > (len(part) - base) // 4:
                base, x, y, cells = base + cut, x[:, cut:], y[:, cut:], cells[:, cut:].copy()
                new = np.empty_like(cells)
            np.add(cells, np.where(y[i - 1 : i - 1 + width] == x[i - 1], hit, miss), out=new)
            np.maximum(new[:-1], cells[1:], out=new[:-1])
            lifted += 1
            if i < width:
                j = i + offset - past[base:]
                new = np.where(j > 0, new, np.where(j == 0, -tilt - 2 * lifted * gap, _LOW))
            if len(part) - base < 64:
                np.maximum.accumulate(new, axis=0, out=new)
            else:
                for b in range(1, width):
                    np.maximum(new[b], new[b - 1], out=new[b])
            if i < width:
                new = np.where(j >= 0, new, _LOW)
            cells, new = new, cells
            if lifted == LIFTED:
                cells += 2 * lifted * gap
                lifted = 0
            up = 2 * lifted * gap
            if near[i] > live[i]:
                r = np.arange(live[i], near[i])
                at_end = r[i > last[r] - width]
                b = last[at_end] - i
                best[at_end] = np.maximum(best[at_end], cells[b, at_end - base] + b * gap + up)
                r = r[ends[r] == i]
                if len(r):
                    best[r] = np.maximum(best[r], np.where(i + offset - past[r] <= full[r], cells[:, r - base] + tilt + up, _LOW).max(0))
        out[part] = best
    low = (1 << _MATCHES) - 1
    return (out >> _MATCHES) & low, out & low


def linked_centres(seqs: DataFrame, key: str, sequence: str, identity: float = 0.3, cover: float = 0.8, k: int = 10, window: int = 10,
                   least_votes: int = 1, band: int = 16) -> DataFrame:
    """``id1, id2, identity``: members and centres whose alignment reaches ``identity`` and covers both.

    Rows grow with the letters, not with pairs: links are sought from a member
    to the centre of each of its words. Two members of a family are linked
    through a centre, or not at all; measure the recall against all pairs.
    Null sequences take no part; a repeated key is the caller's to avoid.
    """
    pairs = materialize(centre_pairs(materialize(minimisers(seqs, key, sequence, k, window), "minimisers"), cover, least_votes), "centre-pairs")
    return banded_links(pairs, seqs, key, sequence, identity, cover, band)


def banded_links(pairs: DataFrame, seqs: DataFrame, key: str, sequence: str, identity: float, cover: float, band: int = 16) -> DataFrame:
    """``id1, id2, identity`` of ``pairs(id, centre, diagonal)`` that hold in a banded alignment; here the sequences are fetched."""
    texts = seqs.select(F.col(key).alias("id"), F.col(sequence).alias("x"))
    full = pairs.join(texts, "id").join(texts.select(F.col("id").alias("centre"), F.col("x").alias("y")), "centre")
    kind = dict(pairs.dtypes)["id"]

    def run(frames):
        for pdf in frames:
            n, columns = banded_counts(pdf["x"].tolist(), pdf["y"].tolist(), pdf["diagonal"].tolist(), band)
            longest = np.maximum(pdf["x"].str.len(), pdf["y"].str.len())
            good = (columns >= cover * longest) & (n >= identity * columns) & (columns > 0)
            yield pdf[["id", "centre"]].set_axis(["id1", "id2"], axis=1).assign(identity=n / np.maximum(columns, 1))[good]

    return full.select("id", "centre", "diagonal", "x", "y").mapInPandas(run, f"id1 {kind}, id2 {kind}, identity double")


# greedy clusters


def short_word_bound(length: Column, identity: float, k: int) -> Column:
    """Words that a sequence within ``identity`` shares at least: each mismatch costs k words at most."""
    return F.greatest(F.lit(1), length - (k - 1) - k * F.floor(F.round(length * (1 - identity), 6))).cast("int")


def word_index(seqs: DataFrame, key: str, sequence: str, k: int) -> DataFrame:
    """``id, n, words``: a sequence's words from rare to common; the second copy of a word in a sequence is another word."""
    text = F.col("s")
    rows = seqs.select(F.col(key).alias("id"), F.col(sequence).alias("s")).where(F.length("s") >= k)
    each = rows.select("id", F.length("s").alias("n"), F.posexplode(F.transform(F.sequence(F.lit(1), F.length(text) - (k - 1)), lambda i: F.substr(text, i, F.lit(k)))).alias("p", "w"))
    copy = F.row_number().over(Window.partitionBy("id", "w").orderBy("p"))
    each = each.withColumn("w", F.xxhash64("w", copy)).select("id", "n", "w")
    ranked = each.join(each.groupBy("w").agg(F.count("*").alias("f")).hint("merge"), "w")
    return ranked.groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("f", "w"))).alias("_l")).select("id", "n", F.col("_l.w").alias("words"))


def _prefix(index: DataFrame, bound: Column) -> DataFrame:
    """``id, n, w``: as many rare words as a pair that shares ``bound`` words must have one of in common."""
    few = F.greatest(F.lit(0), F.size("words") - bound + 1)
    return index.select("id", "n", F.explode(F.slice("words", F.lit(1), few)).alias("w"))


def greedy_bands(seqs: DataFrame, key: str, sequence: str, identity: float = 0.9, cover: float = 0.8, k: int = 5, first: int = 256, most: int = 16384) -> DataFrame:
    """``key, representative``: longest-first greedy clustering; a member joins its most similar representative.

    In order of length (longest first, then key), a sequence that no earlier
    representative is linked to becomes one. A link is an alignment that covers
    both by ``cover`` with ``identity``, between sequences that share the
    short-word bound. Bands of the order grow from ``first`` to ``most`` rows;
    a band meets the representatives so far, and only what they leave is
    compared within the band and settled in one task, which holds ids and links
    of at most ``most`` rows. Joins are merge joins: as broadcasts, every band would
    send its part of the index through the driver. Bands change the work and not the result. Equal
    sequences should be collapsed first (``first_copies``). Sequences with
    fewer than ``k`` letters, and nulls, stand alone; of a repeated key the
    longest, then smallest sequence counts. The bands' tables go at the end.
    """
    with scratch(seqs.sparkSession):
        return materialize(_greedy_bands(seqs, key, sequence, identity, cover, k, first, most), "greedy-clusters", lasting=True)


def _greedy_bands(seqs: DataFrame, key: str, sequence: str, identity: float, cover: float, k: int, first: int, most: int) -> DataFrame:
    one = seqs.groupBy(F.col(key).alias("id")).agg(F.min_by(F.col(sequence), F.struct((-F.length(sequence)).alias("n"), F.col(sequence).alias("s"))).alias("s"))
    one = materialize(one, "greedy-sequences")
    kind = dict(one.dtypes)["id"]
    index = word_index(one, "id", "s", k)
    ranked = global_rank(index.select("id", "words", F.col("n"), (-F.col("n")).alias("_o")), ["_o", "id"], "rank")
    index = materialize(ranked.select("id", "n", "words", "rank").join(one.hint("merge"), "id"), "greedy-words")
    total = index.count()
    own = short_word_bound(F.col("n"), identity, k)
    # a representative may be longer than the sequence by the cover; the least bound of all such lengths counts
    shortest = F.ceil(F.round(F.col("n") * cover, 6)).cast("int")
    least = F.array_min(F.transform(F.sequence(shortest, F.col("n")), lambda m: short_word_bound(m, identity, k)))

    def links(left: DataFrame, right: DataFrame) -> DataFrame:
        """Aligned pairs of ``left`` with earlier rows of ``right``."""
        a = _prefix(left, own)
        b = _prefix(right, least).select(F.col("id").alias("head"), F.col("n").alias("m"), "w")
        met = a.join(b.hint("merge"), "w").where((F.col("id") != F.col("head")) & (F.col("n") >= cover * F.col("m"))).select("id", "head").distinct()
        full = met.join(left.hint("merge"), "id")
        full = full.join(right.select(F.col("id").alias("head"), F.col("words").alias("_w"), F.col("rank").alias("_r"), F.col("s").alias("t")).hint("merge"), "head")
        full = full.where((F.col("_r") < F.col("rank")) & (F.size(F.array_intersect("words", "_w")) >= own)).select("id", "head", "rank", "_r", "s", "t")

        def run(frames):
            for pdf in frames:
                n, columns = align_counts(pdf["t"], pdf["s"])
                longest = np.maximum(pdf["s"].str.len(), pdf["t"].str.len())
                good = (columns >= cover * longest) & (n >= identity * columns)
                yield pdf[["id", "rank", "head"]].assign(head_rank=pdf["_r"], identity=n / np.maximum(columns, 1))[good]

        return full.mapInPandas(run, f"id {kind}, rank long, head {kind}, head_rank long, identity double")

    def settle(pdf):
        """The walk through one band's leftovers: which of them are representatives."""
        reps: set[int] = set()
        for row, heads in sorted(zip(pdf["rank"], pdf["heads"])):
            if not reps.intersection(heads.tolist() if heads is not None else ()):
                reps.add(row)
        return pdf[pdf["rank"].isin(reps)][["id"]]

    found, reps, at, size = [], None, 0, first
    while at < total:
        band = index.where((F.col("rank") >= at) & (F.col("rank") < at + size))
        near = materialize(links(band, reps), "greedy-links") if reps is not None else None
        left = band.join(near.select("id").distinct().hint("merge"), "id", "left_anti") if near is not None else band
        left = materialize(left, "greedy-left")
        inner = materialize(links(band, left), "greedy-links")
        heads = inner.groupBy("id").agg(F.collect_list("head_rank").alias("heads"))
        walk = left.select("id", "rank").join(heads.hint("merge"), "id", "left").groupBy().applyInPandas(settle, f"id {kind}")
        new = materialize(left.join(walk.hint("merge"), "id", "left_semi"), "greedy-new")
        inner = inner.join(new.select(F.col("id").alias("head")).hint("merge"), "head", "left_semi").select("id", "rank", "head", "head_rank", "identity")
        found.append(inner if near is None else inner.unionAll(near))
        reps = new if reps is None else materialize(reps.unionAll(new), "greedy-reps")
        at, size = at + size, min(size * 2, most)
    if not found:
        return one.select(F.col("id").alias(key), F.col("id").alias("representative"))
    every = found[0]
    for part in found[1:]:
        every = every.unionAll(part)
    best = F.min_by("head", F.struct((-F.col("identity")).alias("i"), F.col("head_rank").alias("r")))
    members = every.join(reps.select("id").hint("merge"), "id", "left_anti").groupBy("id").agg(best.alias("representative"))
    return one.select("id").join(members.hint("merge"), "id", "left").select(F.col("id").alias(key), F.coalesce("representative", "id").alias("representative"))
