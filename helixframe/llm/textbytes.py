"""Texts of Arrow batches as byte buffers of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes of one buffer; positions in a buffer must fit 24 bits.
SEGMENT = 1 << 20


def segments(batches, overlap: int, size: int = SEGMENT) -> Iterator[tuple[np.ndarray, ...]]:
    """``(buffer, doc, base, starts, ends)`` of (id, text) batches.

    Documents are laid end to end; one longer than ``size`` is cut into
    segments that overlap by ``overlap`` bytes, ``base`` being a segment's place
    in its document. Null texts are left out.
    """
    held: list[tuple[int, int, bytes]] = []
    count = 0

    def flush():
        sizes = np.array([len(x[2]) for x in held], np.int64)
        ends = np.cumsum(sizes)
        return (np.frombuffer(b"".join(x[2] for x in held), np.uint8), np.array([x[0] for x in held], np.int64),
                np.array([x[1] for x in held], np.int64), ends - sizes, ends)

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if not text:
                continue
            raw = text.encode()
            for base in range(0, max(len(raw) - overlap, 1), size):
                part = raw[base : base + size + overlap]
                held.append((doc, base, part))
                count += len(part)
                if count >= size:
                    yield flush()
                    held, count = [], 0
    if held:
        yield flush()


#: Lower-cases A-Z in UTF-8 bytes.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def settle() -> None:
    """Gives memory that a task has freed back to the system; Python workers outlive their tasks."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


_held: dict[str, dict] = {}


def memory_of(operator: str) -> dict:
    """What a Python worker remembers for an operator between tasks; other operators' memory goes."""
    for other in [k for k in _held if k != operator]:
        del _held[other]
    return _held.setdefault(operator, {})


#: Rows and bytes of the Arrow batches that tasks of the text operators take in.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20


def small_batches(spark) -> None:
    """Sets the session's Arrow batches to the size the text operators are made for."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def _codec():
    import pyarrow as pa

    return pa.Codec("zstd", compression_level=3)


def squeezed(df, text: str):
    """``df`` with one text column compressed, for joins that move whole rows; null stays null."""
    import pyarrow as pa

    names = df.columns
    at = names.index(text)

    def run(batches):
        codec = _codec()
        for batch in batches:
            raw = batch.column(at).cast(pa.binary()).to_pylist()
            small = [t if t is None else np.int64(len(t)).tobytes() + codec.compress(t, asbytes=True) for t in raw]
            yield pa.RecordBatch.from_arrays([pa.array(small, pa.binary()) if i == at else c for i, c in enumerate(batch.columns)], names)

    return df.mapInArrow(run, ", ".join(f"`{c}` {'binary' if c == text else t}" for c, t in df.dtypes))


def expanded(df, text: str):
    """Undoes ``squeezed``."""
    import pyarrow as pa

    names = df.columns
    at = names.index(text)

    def run(batches):
        codec = _codec()
        for batch in batches:
            small = batch.column(at).to_pylist()
            raw = [t if t is None else codec.decompress(t[8:], int(np.frombuffer(t, np.int64, 1)[0]), asbytes=True).decode() for t in small]
            yield pa.RecordBatch.from_arrays([pa.array(raw, pa.string()) if i == at else c for i, c in enumerate(batch.columns)], names)

    return df.mapInArrow(run, ", ".join(f"`{c}` {'string' if c == text else t}" for c, t in df.dtypes))
