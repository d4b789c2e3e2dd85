"""Spelling variants: words at one edit, by dynamic programming over sorted word lists.

Near words differ by one inserted, deleted or replaced code point. A list of
sorted words is walked once: rows of the edit matrix against all words of the
list that are still within one edit are kept for every depth of the common
prefix, three cells of a band wide; the next word goes on from the rows at its
common prefix with the last one, and is passed over as long as a prefix that it
shares has left no other word within one edit.

Lists come from blocks that no near pair straddles: an edit lies in one of the
halves of a word, so words meet where the other half is equal. A block with
more words than a list may have is parted again at the half of its open part,
down to single places, where a block has no more words than there are letters
(and the one with none). A pair is found in the block that has its first
difference, so once.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from operator import methodcaller

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.textbytes import LOWER, settle
from helixframe.session import materialize

RUNS = "[A-Za-zÀ-ÿ]+"
#: Letters of a long text.
LONG = 1 << 20
#: Words of the largest list that is walked in one piece.
LIST = 64
#: Distinct words a task counts before it hands the counts on.
HELD = 1 << 18


def run_counts(text: str, pattern: re.Pattern) -> Counter:
    """Counts of a text's runs, A-Z in lower case; a long text's runs are never held together."""
    low = text.encode().translate(LOWER).decode()
    return Counter(pattern.findall(low) if len(low) < LONG else map(methodcaller("group"), pattern.finditer(low)))


def slip(run: str, h: int) -> str:
    """The run without one code point, which the hash names; a stand-in for typing errors."""
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = 5, least: int = 3, slip_rate: int | None = None) -> DataFrame:
    """``word, n`` of the words with ``least_length`` code points that occur ``least`` times.

    Counts are summed in the tasks before they are shuffled. Null and empty
    texts have no words. ``slip_rate``: where it divides the crc32 of
    ``<key>:<run>``, the run loses a letter (``slip``).
    """

    def run(batches):
        pattern, held = re.compile(RUNS), Counter()

        def flush():
            words = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return words

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                start = zlib.crc32(f"{key}:".encode())
                for w, n in run_counts(text or "", pattern).items():
                    if len(w) >= least_length:
                        if slip_rate and not (h := zlib.crc32(w.encode(), start)) % slip_rate:
                            w = slip(w, h)
                        held[w] += n
                if len(held) >= HELD:
                    yield flush()
        yield flush()
        settle()

    return docs.select(key, docs[text].alias("_text")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where((F.col("n") >= least) & (F.length("word") >= least_length))


# near words of one list


def common_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    for i in range(n):
        if a[i] != b[i]:
            return i
    return n


def near_in_list(words: list[str]) -> list[tuple[int, int]]:
    """Pairs ``(i, j)``, ``i < j``, of distinct sorted ``words`` at one edit; their lengths differ by one at most."""
    padded = [f"\0{w}\0\0\0" for w in words]
    # rows[d]: the words within one edit of the current prefix of d letters, with the cells of d-1, d and d+1 of their letters
    rows = [[(j, 2, 0, 1) for j in range(len(words))]]
    out: list[tuple[int, int]] = []
    last, dead = "", len(max(words, key=len)) + 1
    for i, word in enumerate(words):
        common = common_prefix(last, word)
        last = word
        if common >= dead:  # the prefix that left no other word is shared
            continue
        dead = len(padded[i])
        del rows[common + 1 :]
        for d in range(common + 1, len(word) + 1):
            c, row = word[d - 1], []
            for j, x, y, z in rows[-1]:
                t = padded[j]
                x = min(x + (t[d - 1] != c), y + 1)
                y = min(y + (t[d] != c), z + 1, x + 1)
                z = min(z + (t[d + 1] != c), y + 1)
                if x < 2 or y < 2 or z < 2:
                    row.append((j, x, y, z))
            if len(row) < 2:  # nothing but the word itself
                dead = d
                break
            rows.append(row)
        else:
            for j, *cells in rows[-1]:
                if j > i and abs(side := len(words[j]) - len(word)) < 2 and cells[side + 1] == 1:
                    out.append((i, j))
    return out


# near words of a vocabulary


def _settled(batches):
    """Per word of a block the number of its near words there, and the best of them: the most frequent, then the smallest."""

    def walk(held):
        _, short, low, high, _, _ = held[0]
        rows = sorted((w[low : high + len(w) - short], w, n) for *_, w, n in held)
        open_, words, counts = zip(*rows)
        best: dict[int, list] = {}
        for i, j in near_in_list(open_):
            one, two = words[i], words[j]
            # pairs of two longer words have blocks of their own; the end of the shorter word belongs to the last part
            first = low + common_prefix(open_[i], open_[j])
            if min(len(one), len(two)) > short or first >= high and high < short or one[:low] != two[:low]:
                continue
            for a, b in ((i, j), (j, i)):
                have = best.setdefault(a, [0, b])
                have[0] += 1
                if (-counts[b], words[b]) < (-counts[have[1]], words[have[1]]):
                    have[1] = b
        return [(words[a], counts[a], k, words[b], counts[b]) for a, (k, b) in best.items()]

    def table(rows):
        cols = list(zip(*rows)) if rows else [[]] * 5
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["word", "n", "n_near", "near", "near_n"])

    held, out = [], []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and row[:4] != held[0][:4]:
                if len(held) > 1:
                    out += walk(held)
                held = []
            held.append(row)
        if len(out) >= 4096:
            yield table(out)
            out = []
    if len(held) > 1:
        out += walk(held)
    yield table(out)
    settle()


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows ``word, n, short, low, high`` with ``block``: equal words but for the letters from ``low`` up to ``high``."""
    rest = F.concat(F.expr("left(word, low)"), F.lit("\0"), F.expr("substring(word, high + 1 + length(word) - short)"))
    return rows.withColumn("block", F.xxhash64("short", "low", "high", rest))


def _halved(rows: DataFrame) -> DataFrame:
    """Each open part as its two halves."""
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    halves = F.array(F.struct(F.col("low").alias("low"), middle.alias("high")), F.struct(middle.alias("low"), F.col("high").alias("high")))
    return rows.withColumn("_half", F.explode(halves)).select("word", "n", "short", "_half.low", "_half.high")


def near_words(words: DataFrame, largest: int = LIST) -> DataFrame:
    """``word, n_near, near, near_n`` of the words that have near words, from distinct ``word, n``.

    ``near`` is the near word of largest ``n``, on ties the smallest in code-point
    order. Every word goes to four blocks at first; only the rows of blocks with
    more than ``largest`` words go further.
    """
    both = F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("short")
    open_ = words.select("word", "n", both).where("short > 0").select("word", "n", "short", F.lit(0).alias("low"), F.col("short").alias("high"))
    rows, found = materialize(_blocks(_halved(open_)), "word-blocks"), None
    while True:
        sizes = rows.groupBy("block").agg(F.count("*").alias("size"), F.max(F.col("high") - F.col("low")).alias("wide")).where("size > 1")
        # single places have no more words than letters; their blocks are walked whatever their size
        sizes = materialize(sizes.withColumn("whole", (F.col("size") <= largest) | (F.col("wide") <= 1)), "word-block-sizes")
        lists = rows.join(sizes.where("whole").select("block"), "block", "left_semi").select("block", "short", "low", "high", "word", "n")
        lists = lists.repartition("block").sortWithinPartitions("block", "short", "low", "high", "word")
        part = lists.mapInArrow(_settled, "word string, n long, n_near long, near string, near_n long")
        found = part if found is None else found.unionAll(part)
        if sizes.where("not whole").isEmpty():
            break
        large = rows.join(sizes.where("not whole").select("block"), "block", "left_semi")
        rows = materialize(_blocks(_halved(large)), "word-blocks")
    best = F.min_by(F.struct("near", "near_n"), F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("w")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_b")).select("word", "n_near", "_b.near", "_b.near_n")


def variant_groups(words: DataFrame, factor: int = 2, largest: int = LIST) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of distinct ``word, n`` with positive ``n``.

    A word's form is its most frequent near word (ties: the smallest in
    code-point order) if that has ``factor`` (2 or more) times its count, else
    null; its root is where its forms end. Counts grow by the factor from form
    to form, so the steps to a root are few, and each round of joins doubles
    them; only words whose form has a form take part. A null word is left out.
    """
    if factor < 2:
        raise ValueError("factor must be 2 or more, or forms may run in circles")
    words = materialize(words.where("word IS NOT NULL").select("word", F.col("n").cast("long").alias("n")), "words")
    linked = words.join(near_words(words, largest), "word", "left").withColumn("_ok", F.col("near_n") >= factor * F.col("n"))
    linked = materialize(linked.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("_ok"), F.col("near")).alias("form"),
        F.when(F.col("_ok"), F.col("near_n")).alias("form_n")), "word-forms")
    ends = linked.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        ahead = ends.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step = materialize(ends.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "word-roots")
        ends = step.select("word", "root")
        if step.where("_moved").isEmpty():
            break
    return linked.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
