"""Quality classifier: a byte-level convolutional network in numpy.

A document's bytes are embedded; learned filters of eight bytes slide over them
in steps of four; overlapping chunks (512 bytes, every 256) take the maximum of
every filter, so the chunks cover the whole document. The mean of the chunks'
maxima goes through a logistic unit to one probability.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.session import materialize, scratch

HALF, STEP, DIM, FILTERS = 256, 4, 4, 16
#: Labelled rows that training uses (about), and the bytes of their texts up to which the driver keeps them between epochs.
TRAIN_ROWS, HELD_BYTES = 2_400, 48 << 20
EPOCHS, BATCH, RATE = 10, 32, 0.004
#: Bytes that are scored together, and chunks that learn together.
BLOCK, CHUNKS = 1 << 20, 1024


@dataclass
class Network:
    embed: np.ndarray  # 256 x DIM
    filters: np.ndarray  # STEP * DIM x 2 * FILTERS: first and second half of each filter
    bias: np.ndarray
    out: np.ndarray  # FILTERS + 1


def _halves(data: np.ndarray, net: Network, last: np.ndarray) -> np.ndarray:
    """Filter maxima of every 256 bytes; ``last`` marks steps that end a document."""
    x = net.embed[data].reshape(-1, STEP * DIM)
    y = x @ net.filters
    z = y[:, :FILTERS]
    z[:-1] += np.where(last[:-1, None], np.float32(0), y[1:, FILTERS:])
    return z.reshape(-1, HALF // STEP, FILTERS).max(1)


def probabilities(texts: list[bytes], net: Network) -> np.ndarray:
    """One probability a text; every byte of every text is read."""
    out = np.empty(len(texts))
    at = 0
    while at < len(texts):
        end, held = at, 0
        while end < len(texts) and (end == at or held < BLOCK):
            held += len(texts[end])
            end += 1
        sizes = [max(1, -(-len(t) // HALF)) for t in texts[at:end]]
        raw = b"".join(t.ljust(n * HALF, b"\0") for t, n in zip(texts[at:end], sizes))
        ends = np.cumsum(sizes)
        data = np.frombuffer(raw, np.uint8)
        # a longer document passes in blocks of whole halves, each with the next block's first step
        tops, block = [], BLOCK // HALF
        for b in range(0, int(ends[-1]), block):
            part = data[b * HALF : (b + block) * HALF + STEP]
            spare = len(part) % HALF
            part = np.concatenate([part, np.zeros(HALF - spare, np.uint8)]) if spare else part
            last = np.zeros(len(part) // STEP, bool)
            local = ends[(ends > b) & (ends <= b + len(part) // HALF)] - b
            last[local * (HALF // STEP) - 1] = True
            last[-1] = True
            tops.append(_halves(part, net, last)[: min(block, int(ends[-1]) - b)])
        top = np.maximum(np.concatenate(tops) + net.bias, 0)
        starts = ends - sizes
        chunk = top.copy()
        chunk[:-1] = np.maximum(top[:-1], top[1:])
        chunk[ends - 1] = top[ends - 1]
        # a chunk begins at every half but the last; a document of one half has one chunk
        many = np.array(sizes) > 1
        sums = np.add.reduceat(chunk, starts, axis=0)
        sums[many] -= chunk[(ends - 1)[many]]
        mean = sums / np.maximum(np.array(sizes) - many, 1)[:, None]
        out[at:end] = 1 / (1 + np.exp(-(mean @ net.out[:-1] + net.out[-1])))
        at = end
    return out


@dataclass
class Learner:
    """A network in training by Adam on the log loss."""

    net: Network
    first: list[np.ndarray]
    second: list[np.ndarray]
    rng: np.random.Generator
    step: int = 0

    @classmethod
    def new(cls, rate: float | None, seed: int = 5) -> Learner:
        """``rate``: the share of label 1; None if there is nothing to learn from."""
        rng = np.random.default_rng(seed)
        net = Network(rng.normal(0, 0.5, (256, DIM)).astype(np.float32), rng.normal(0, 0.25, (STEP * DIM, 2 * FILTERS)).astype(np.float32),
                      np.zeros(FILTERS, np.float32), np.zeros(FILTERS + 1, np.float32))
        if rate is not None:
            rate = float(np.clip(rate, 0.01, 0.99))
            net.out[-1] = math.log(rate / (1 - rate))
        weights = [net.embed, net.filters, net.bias, net.out]
        return cls(net, [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], rng)

    def learn(self, texts: list[bytes], labels: list[int]) -> None:
        """One step on the whole texts of a batch; memory is bounded by the bytes of the texts that pass together."""
        net, shift = self.net, -int(self.rng.integers(STEP))
        weights = [net.embed, net.filters, net.bias, net.out]
        sums = [np.zeros_like(w) for w in weights]
        at = 0
        while at < len(texts):
            end, held = at, 0
            while end < len(texts) and (end == at or held < BLOCK):
                held += len(texts[end])
                end += 1
            for total, part in zip(sums, _gradients(net, texts[at:end], np.array(labels[at:end], np.float32), shift, len(texts))):
                total += part
            at = end
        self.step += 1
        for w, g, m, v in zip(weights, sums, self.first, self.second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= RATE * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.999**self.step)) + 1e-8)


def _inputs(net: Network, data: np.ndarray) -> np.ndarray:
    return net.embed[data].reshape(len(data), -1, STEP * DIM)


def _gradients(net: Network, texts: list[bytes], labels: np.ndarray, shift: int, batch: int) -> tuple[np.ndarray, ...]:
    """Gradients of embeddings, filters, bias and output; chunks pass in blocks, forth and back."""
    chunks, owner = training_chunks(texts)
    blocks = range(0, len(chunks), CHUNKS)
    where, tops = [], []
    cols = np.arange(FILTERS)
    for b in blocks:
        data = np.roll(chunks[b : b + CHUNKS], shift, axis=1)
        y = _inputs(net, data) @ net.filters
        z = y[:, :-1, :FILTERS] + y[:, 1:, FILTERS:]
        at = z.argmax(1)
        where.append(at)
        tops.append(z[np.arange(len(data))[:, None], at, cols] + net.bias)
    top = np.concatenate(tops)
    n = np.bincount(owner)[:, None].astype(np.float32)
    # chunks come document by document
    mean = np.add.reduceat(np.maximum(top, 0), np.concatenate([[0], np.cumsum(n[:-1], dtype=np.int64)]), axis=0) / n
    p = 1 / (1 + np.exp(-(mean @ net.out[:-1] + net.out[-1])))
    error = (p - labels).astype(np.float32) / batch
    g_top = (error[:, None] * net.out[:-1] / n)[owner] * (top > 0)
    g_filters, g_embed = np.zeros_like(net.filters), np.zeros_like(net.embed)
    for b, at in zip(blocks, where):
        data, flow_top = np.roll(chunks[b : b + CHUNKS], shift, axis=1), g_top[b : b + CHUNKS]
        x, rows = _inputs(net, data), np.arange(len(data))[:, None]
        g_filters += np.concatenate([np.einsum("cfi,cf->if", x[rows, at + s], flow_top) for s in (0, 1)], 1)
        for s, part in ((0, net.filters[:, :FILTERS]), (1, net.filters[:, FILTERS:])):
            flow = (flow_top[:, :, None] * part.T).reshape(len(data), FILTERS, STEP, DIM)
            bytes_at = data[rows[:, :, None], (at + s)[:, :, None] * STEP + np.arange(STEP)]
            for k in range(DIM):
                g_embed[:, k] += np.bincount(bytes_at.ravel(), flow[..., k].ravel(), 256)
    return g_embed, g_filters, g_top.sum(0), np.append(error @ mean, error.sum())


def training_chunks(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The overlapping chunks of whole texts, as scoring takes them, and each one's text."""
    counts = [max(1, -(-len(t) // HALF) - 1) for t in texts]
    halves = np.frombuffer(b"".join(t.ljust((n + 1) * HALF, b"\0") for t, n in zip(texts, counts)), np.uint8).reshape(-1, HALF)
    owner = np.repeat(np.arange(len(texts)), counts)
    first = np.arange(len(owner)) + owner
    return np.concatenate([halves[first], halves[first + 1]], 1), owner


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "label",
          max_rows: int = TRAIN_ROWS, held_bytes: int = HELD_BYTES) -> Network:
    """Learns from the whole texts of a sample of ``labels`` (key, label).

    The sample is drawn by the hash of the key, about ``max_rows`` rows, whatever
    their texts' lengths. It is written once; texts of up to ``held_bytes``
    together are kept between epochs, more are read again for each epoch, a few
    rows at a time and in the same order, which changes nothing in the result.
    Null labels and keys are left out; a null text is an empty one; of a repeated
    key the largest label and the smallest text count. Without rows
    the network gives one half. Other columns may have any names.
    """
    rows = labels.select(labels[key].alias("k"), labels[label].cast("int").alias("label")).where("k IS NOT NULL AND label IS NOT NULL")
    rows = rows.groupBy("k").agg(F.max("label").alias("label"))
    total = rows.count()
    grain = 1 << 20
    order = F.xxhash64("k", F.lit("quality"))
    sample = rows.where(F.pmod(order, F.lit(grain)) < math.ceil(grain * min(1.0, max_rows / max(total, 1))))
    texts = docs.select(docs[key].alias("k"), F.coalesce(docs[text], F.lit("")).alias("text"))
    with scratch(docs.sparkSession):
        picked = texts.join(F.broadcast(sample), "k").groupBy("k", "label").agg(F.min("text").alias("text"))
        picked = materialize(picked.select(order.alias("h"), "label", "text"), "labelled")
        facts = picked.agg(F.count("*").alias("n"), F.avg("label").alias("rate"), F.sum(F.octet_length("text").cast("long")).alias("bytes")).first()
        learner = Learner.new(facts.rate)
        if not facts.n:
            return learner.net
        at = [F.xxhash64("h", F.lit(e)) for e in range(EPOCHS)]
        held = picked.select("label", "text", *(c.alias(f"e{e}") for e, c in enumerate(at))).toArrow().to_pylist() if facts.bytes <= held_bytes else None
        for e in range(EPOCHS):
            if held is not None:
                found = ((r["label"], r["text"]) for r in sorted(held, key=lambda r: (r[f"e{e}"], r["label"], r["text"])))
            else:
                found = picked.repartitionByRange(facts.n // 4 + 1, at[e]).sortWithinPartitions(at[e], "label", "text").select("label", "text").toLocalIterator()
            while batch := list(islice(found, BATCH)):
                learner.learn([t.encode() for _, t in batch], [y for y, _ in batch])
    return learner.net


def score(df: DataFrame, net: Network, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row: ``key``, the columns of ``keep`` and ``score`` from 0 to 1.

    Null and empty texts are scored as one empty chunk. Rows are independent:
    repeated rows repeat, an empty table stays empty, columns not named in
    ``keep`` are left out.
    """
    keep = tuple(c for c in keep if c not in (key, "score"))
    fields = ", ".join(f"`{c}` {t}" for c, t in df.select(key, *keep).dtypes)
    shipped = df.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(probabilities(texts, shipped.value), pa.float64())], [key, *keep, "score"])

    return df.select(key, *keep, df[text].alias("_text")).mapInArrow(run, f"{fields}, score double")
