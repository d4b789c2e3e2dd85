"""A Python data source for macromolecular structure files.

It yields the long table ``entry_id, category, row_ord, item, value``; the
``categories`` option (comma separated) leaves other categories unread. Named
files are dealt over a bounded number of tasks; a folder is packed by size.
"""

from __future__ import annotations

import gzip
import io
import re
from collections.abc import Generator, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, In, InputPartition, IsNotNull

#: Tasks over named files, at most; bytes of a piece of a file; rows of a batch; bytes read at once.
TASKS, SPLIT, BATCH, CHUNK = 4096, 32 << 20, 1 << 14, 1 << 18
SCHEMA = "entry_id string, category string, row_ord long, item string, value string"
#: A category's row as one row: its values by item, which ``pivot_category`` takes as well.
ROWS = "entry_id string, category string, row_ord long, cells map<string, string>"


def _line_tokens(line: str, lines: Iterator[str]) -> Iterator[tuple[str, bool]]:
    if line.startswith(";"):
        parts = [line[1:]]
        for more in lines:
            if more.startswith(";"):
                break
            parts.append(more)
        yield "\n".join(parts).rstrip("\r"), True
        return
    if not _special(line):
        for value in line.split():
            yield value, False
        return
    at, n = 0, len(line)
    while at < n:
        ch = line[at]
        if ch.isspace():
            at += 1
        elif ch == "#":
            break
        elif ch in "'\"":
            end = at + 1
            while end < n and not (line[end] == ch and (end + 1 == n or line[end + 1].isspace())):
                end += 1
            yield line[at + 1 : end], True
            at = end + 1
        else:
            end = at
            while end < n and not line[end].isspace():
                end += 1
            yield line[at:end], False
            at = end


def _special(line: str) -> bool:
    return "'" in line or '"' in line or "#" in line


def tokens(text: str) -> Iterator[tuple[str, bool]]:
    """Values and whether they were quoted; text fields between ``;`` lines are one value."""
    lines = iter(text.split("\n"))
    for line in lines:
        yield from _line_tokens(line, lines)


def _rows(text: str, wanted: set[str] | None, entry: str = "") -> Generator[tuple[str, str, int, list[str], list[str]], None, str]:
    """The rows of ``parse_rows``, and the entry at the end."""
    loop, names, items, row, held = False, [], [], [], None
    number, category, keep = 0, "", False

    def flush():
        if row:
            raise ValueError(f"{entry}: {len(row)} values too many in {names[:1]}")

    lines = iter(text.split("\n"))
    for line in lines:
        if loop and names and "_" not in line and not line.startswith(";") and not _special(line):
            # values alone: no name, keyword or quote
            row += line.split()
        else:
            for value, quoted in _line_tokens(line, lines):
                low = value.lower() if not quoted else ""
                if low.startswith("data_"):
                    flush()
                    entry, loop, names, items, held = value[5:], False, [], [], None
                elif low == "loop_":
                    flush()
                    loop, names, items, row, number = True, [], [], [], 0
                elif not quoted and value.startswith("_"):
                    if loop and (number or row):
                        flush()
                        loop, names, items = False, [], []
                    if loop:
                        names.append(value)
                        items.append(value.partition(".")[2])
                        category = names[0].partition(".")[0]
                        keep = wanted is None or category in wanted
                    else:
                        held = value
                elif loop:
                    row.append(value)
                    if len(row) == len(names):
                        if keep:
                            yield entry, category, number, items, row
                        row, number = [], number + 1
                elif held is not None:
                    alone, _, item = held.partition(".")
                    if wanted is None or alone in wanted:
                        yield entry, alone, 0, [item], [value]
                    held = None
        if row and names and len(row) >= (n := len(names)):
            if len(row) == n:
                if keep:
                    yield entry, category, number, items, row
                row, number = [], number + 1
            else:
                for at in range(0, len(row) - n + 1, n):
                    if keep:
                        yield entry, category, number, items, row[at : at + n]
                    number += 1
                row = row[len(row) // n * n :]
    flush()
    return entry


#: Heads of loops by their first line: text, items and category.
_heads: dict[str, tuple[str, list[str], str]] = {}


def _head(piece: str) -> tuple[str, list[str], str] | None:
    """The lines of a loop's names, which are the same in most entries; none if one of them holds more than a name."""
    first = piece[: piece.find("\n") + 1]
    known = _heads.get(first)
    if known and piece.startswith(known[0]):
        return known
    names, at = [], 0
    while piece.startswith("_", at):
        end = piece.find("\n", at)
        names.append(piece[at:end])
        if end < 0 or len(piece[at:end].split()) != 1 or _special(names[-1]):
            return None
        at = end + 1
    if not names:
        return None
    if len(_heads) >= 4096:
        _heads.clear()
    _heads[first] = piece[:at], [n.partition(".")[2].rstrip() for n in names], names[0].partition(".")[0].rstrip()
    return _heads[first]


def parse_rows(text: str, wanted: set[str] | None = None) -> Iterator[tuple[str, str, int, list[str], list[str]]]:
    """``entry, category, row_ord, items, values`` of every row; a loop's values that don't fill its last row raise.

    A loop whose values hold no name or keyword is split at once; all others,
    and texts with text fields or comments, are read value by value.
    """
    if "#" in text or "\n;" in text or text.startswith(";"):
        yield from _rows(text, wanted)
        return
    before, *loops = text.split("\nloop_\n")
    if before.startswith("data_") and len(before.split()) == 1 and not _special(before):
        entry = before[5:].rstrip()
    else:
        entry = yield from _rows(before, wanted)
    for piece in loops:
        head = _head(piece)
        body = piece[len(head[0]) :] if head else "_"
        if "_" in body:
            entry = yield from _rows(f"loop_\n{piece}", wanted, entry)
            continue
        if _special(body):
            values = [value for line in body.split("\n") for value, _ in _line_tokens(line, iter(()))]
        else:
            values = body.split()
        _, items, category = head
        n = len(items)
        if len(values) % n:
            entry = yield from _rows(f"loop_\n{piece}", wanted, entry)
        elif wanted is None or category in wanted:
            for number, at in enumerate(range(0, len(values), n)):
                yield entry, category, number, items, values[at : at + n]


def parse(text: str, wanted: set[str] | None = None) -> Iterator[tuple[str, str, int, str, str]]:
    """Rows of the long table; a loop's values that don't fill its last row raise."""
    for entry, category, number, items, values in parse_rows(text, wanted):
        for item, value in zip(items, values):
            yield entry, category, number, item, value


def _cells(items: list[str], values: list[str]) -> dict[str, str]:
    """A row's values by item; of a repeated item the largest, as the pivot of the long table has it."""
    cells: dict[str, str] = {}
    for item, value in zip(items, values):
        cells[item] = max(value, cells.get(item, value))
    return cells


_DATA = re.compile(rb"^data_", re.IGNORECASE | re.MULTILINE)


def blocks(f, start: int, end: int | None) -> Iterator[str]:
    """The blocks of a binary file whose ``data_`` line begins from ``start`` up to before ``end``."""
    at = max(start - 1, 0)
    f.seek(at)
    if start:
        at += len(f.readline())  # a block that begins at start is kept
    held, inside = b"", False
    while True:
        # whole lines, from the place at
        more = f.read(CHUNK)
        more += f.readline() if more else b""
        text, begin, seen = held + more, 0, len(held)
        for found in _DATA.finditer(text, seen):
            if inside:
                yield text[begin : found.start()].decode()
            if end is not None and at + found.start() - seen >= end:
                return
            begin, inside = found.start(), True
        if not more:
            break
        at += len(more)
        held = text[begin:] if inside else b""
    if inside:
        yield held.decode()


class _Part(InputPartition):
    """Pieces ``(path, start, end)`` of files; a file read whole has no end."""

    def __init__(self, pieces: list[tuple[str, int, int | None]]):
        self.pieces = pieces


def _store(path: str):
    import pyarrow.fs as pafs

    return pafs.FileSystem.from_uri(path if "://" in path else f"file://{path.removeprefix('file:')}")


class _Held:
    """Rows on their way into Arrow batches: a row a cell or, as ``rows``, a row with its cells."""

    def __init__(self, rows: bool, keyed: bool = False):
        self.rows, self.keyed = rows, keyed
        self._clear()

    def _clear(self):
        self.heads, self.items, self.values, self.ends = ([], [], []), [], [], [0]
        self.kinds: dict[int, tuple[int, list[str], list[str]]] = {}
        self.kind: list[int] = []
        self.keys, self.errors = [], []

    def __len__(self) -> int:
        return len(self.heads[0])

    def full(self) -> bool:
        return len(self.values) >= BATCH

    def add(self, row: tuple, key: str | None = None, error: str | None = None):
        *head, items, values = row
        if self.rows:
            # rows of a loop share their list of items
            known = self.kinds.get(id(items))
            if known is None:
                known = self.kinds[id(items)] = (len(self.kinds), items, list(dict.fromkeys(items)))
            if len(known[2]) < len(items):
                values = _cells(items, values).values()
            self.kind.append(known[0])
        n = 1 if self.rows else len(items)
        for column, v in zip(self.heads, head):
            column += [v] * n
        if not self.rows:
            self.items += items
        self.values += values
        self.ends.append(len(self.values))
        if self.keyed:
            self.keys += [key] * n
            self.errors += [error] * n

    def _names(self, text):
        """The items of all rows' cells, each name taken from the rows' lists."""
        import numpy as np
        import pyarrow as pa

        lists = [items for _, _, items in self.kinds.values()]
        starts = np.cumsum([0] + [len(x) for x in lists])[np.array(self.kind, np.int64)]
        ends = np.array(self.ends, np.int64)
        at = np.repeat(starts - ends[:-1], np.diff(ends)) + np.arange(ends[-1])
        return pa.array([i for x in lists for i in x], text).take(pa.array(at))

    def batch(self):
        import pyarrow as pa

        names, text = ["entry_id", "category", "row_ord"], pa.string()
        columns = [pa.array(c, k) for c, k in zip(self.heads, (text, text, pa.int64()))]
        values = pa.array(self.values, text)
        if self.rows:
            names, columns = [*names, "cells"], [*columns, pa.MapArray.from_arrays(pa.array(self.ends, pa.int32()), self._names(text), values)]
        else:
            names, columns = [*names, "item", "value"], [*columns, pa.array(self.items, text), values]
        if self.keyed:
            names, columns = [*names, "key", "error"], [*columns, pa.array(self.keys, text), pa.array(self.errors, text)]
        self._clear()
        return pa.RecordBatch.from_arrays(columns, names)


class _Scan:
    """What the batch and the stream reader share."""

    def __init__(self, options: dict):
        self.paths = [p for p in options.get("paths", options.get("path", "")).split(",") if p]
        names = options.get("categories", "")
        self.wanted = {c.strip() for c in names.split(",") if c.strip()} or None
        self.rows = options.get("rows", "") == "true"
        self.split = int(options.get("splitbytes", options.get("splitBytes", SPLIT)))

    def pieces(self, paths: list[str]) -> list[tuple[str, int, int | None]]:
        """Large files with several blocks in ranges of bytes; compressed ones whole."""
        out: list[tuple[str, int, int | None]] = []
        for path in paths:
            size = 0
            if not path.endswith(".gz"):
                store, name = _store(path)
                size = store.get_file_info(name).size or 0
            if size <= self.split:
                out.append((path, 0, None))
            else:
                out += [(path, at, min(at + self.split, size)) for at in range(0, size, self.split)]
        return out

    def dealt(self, paths: list[str]) -> list[_Part]:
        pieces = self.pieces(paths)
        each = max(1, -(-len(pieces) // TASKS))
        return [_Part(pieces[i : i + each]) for i in range(0, len(pieces), each)]

    def read(self, partition):
        held = _Held(self.rows)
        for path, start, end in partition.pieces:
            store, name = _store(path)
            with store.open_input_file(name) as raw:
                f = gzip.GzipFile(fileobj=raw) if name.endswith(".gz") else io.BufferedReader(raw)
                for text in blocks(f, start, end):
                    for row in parse_rows(text, self.wanted):
                        held.add(row)
                        if held.full():
                            yield held.batch()
        if len(held):
            yield held.batch()


class _Reader(_Scan, DataSourceReader):
    def pushFilters(self, filters):  # noqa: N802
        """Equality and membership of ``category`` reach the parser; the rest is Spark's."""
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("category",):
                self.wanted = {f.value} if self.wanted is None else self.wanted & {f.value}
            elif isinstance(f, In) and f.attribute == ("category",):
                self.wanted = set(f.value) if self.wanted is None else self.wanted & set(f.value)
            elif not (isinstance(f, IsNotNull) and f.attribute == ("category",)):  # no row is without one
                yield f

    def partitions(self):
        return self.dealt(self.paths)


class _StreamReader(_Scan, DataSourceStreamReader):
    """Files below the paths in the order of their time and name; an offset is the last file read."""

    def _listed(self) -> list[tuple[int, str]]:
        import pyarrow.fs as pafs

        out = []
        for path in self.paths:
            store, name = _store(path)
            scheme = path[: path.index("://") + 3] if "://" in path else ""
            found = store.get_file_info(pafs.FileSelector(name, recursive=True))
            out += [(int(i.mtime_ns or 0), scheme + i.path) for i in found if i.is_file and i.path.endswith((".cif", ".cif.gz"))]
        return sorted(out)

    def initialOffset(self):  # noqa: N802
        return {"time": -1, "path": ""}

    def latestOffset(self):  # noqa: N802
        listed = self._listed()
        time, path = listed[-1] if listed else (-1, "")
        return {"time": time, "path": path}

    def partitions(self, start, end):
        low, high = (start["time"], start["path"]), (end["time"], end["path"])
        return self.dealt([path for time, path in self._listed() if low < (time, path) <= high])

    def commit(self, end):
        pass


class MmcifSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "mmcif"

    def schema(self) -> str:
        return ROWS if self.options.get("rows") == "true" else SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return _StreamReader(self.options)


def _registered(spark: SparkSession) -> None:
    spark.dataSource.register(MmcifSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_mmcif(spark: SparkSession, paths: list[str], categories: list[str] | None = None, split: int | None = None, rows: bool = False) -> DataFrame:
    """The long table of named files, files of many blocks in pieces of about ``split`` bytes; with ``rows`` a row a category's row.

    Filters on ``category`` reach the parser (``pushFilters``), as ``categories`` does.
    """
    _registered(spark)
    reader = spark.read.format("mmcif").option("paths", ",".join(paths)).option("splitBytes", split or SPLIT).option("rows", "true" if rows else "false")
    return (reader.option("categories", ",".join(categories)) if categories else reader).load()


def stream_mmcif(spark: SparkSession, folder: str, categories: list[str] | None = None) -> DataFrame:
    """A stream of the long table of the folder's files, each once, in the order of their times.

    A file must be complete when it appears, and later files have later times.
    """
    _registered(spark)
    reader = spark.readStream.format("mmcif").option("path", folder)
    return (reader.option("categories", ",".join(categories)) if categories else reader).load()


def parse_texts(df: DataFrame, key: str, text: str, categories: list[str] | None = None, rows: bool = False, whole: bool = False) -> tuple[DataFrame, DataFrame]:
    """The long table (with ``rows`` a row a category's row) of texts in a column, and the quarantine ``key, error`` of texts that don't parse.

    With ``whole`` as well, where no two texts are of one entry, rows of one
    number in a category are one, and the cells' column is ``row``: then
    ``pivot_category`` has no rows to bring together.
    """
    wanted = set(categories) if categories else None
    texts = df.select(F.col(key).cast("string").alias("key"), F.encode(text, "UTF-8").alias("content"))
    found = texts.mapInArrow(_parsed(wanted, rows, whole), (ROWS if rows else SCHEMA) + ", key string, error string")
    found = found.withColumnRenamed("cells", "row") if rows and whole else found
    return found.where("error is null").drop("key", "error"), found.where("error is not null").select("key", "error")


def _merged(rows: list[tuple]) -> list[tuple]:
    """One row for each entry, category and number; of an item's values the largest, as the pivot has it."""
    if len({row[:3] for row in rows}) == len(rows):
        return rows
    cells: dict[tuple, tuple[list, list]] = {}
    for *head, items, values in rows:
        held = cells.setdefault(tuple(head), ([], []))
        held[0].extend(items)
        held[1].extend(values)
    return [(*head, list(found), list(found.values())) for head, (items, values) in cells.items() for found in (_cells(items, values),)]


def _parsed(wanted: set[str] | None, wide: bool = False, whole: bool = False):
    """A task over ``key, content`` that parses each content; a key that ends in .gz is compressed."""

    def run(batches):
        held = _Held(wide, keyed=True)
        for batch in batches:
            for path, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    text = (gzip.decompress(raw) if (path or "").endswith(".gz") else raw or b"").decode()
                    rows = list(parse_rows(text, wanted))
                    for row in _merged(rows) if whole else rows:
                        held.add(row, path)
                except (ValueError, OSError) as e:
                    held.add((None, None, None, [None] * (not wide), [None] * (not wide)), path, str(e)[:500])
                if held.full():
                    yield held.batch()
        if len(held):
            yield held.batch()

    return run


def read_mmcif_folder(spark: SparkSession, folder: str, categories: list[str] | None = None, pattern: str = "*.cif*") -> tuple[DataFrame, DataFrame]:
    """The long table of all files below a folder, read through Spark's own file source, and a quarantine ``key, error``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder).select("path", "content")
    wanted = set(categories) if categories else None
    whole = files.mapInArrow(_parsed(wanted), SCHEMA + ", key string, error string")
    return whole.where("error is null").select("entry_id", "category", "row_ord", "item", "value"), whole.where("error is not null").select("key", "error")


def normal_ids(long: DataFrame) -> DataFrame:
    """Entry ids in lower case, as they are joined everywhere."""
    return long.withColumn("entry_id", F.lower("entry_id"))
