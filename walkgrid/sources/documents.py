"""One large JSON document read by many tasks: the elements of one of its arrays, cut at object borders.

Where an object starts depends on all that stands before: on being inside a string, and on depth. So there are two passes over byte
ranges. The first (``_ranges``) sums up each range for both cases, starting inside a string or not: whether it ends inside one, by
how much the depth changes, and how low it gets. Those few numbers a range, put together in order, tell the state at each start.
The second pass is a Python data source whose partitions are the ranges: each reads the elements that start in its own.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of a range. A task holds one, and the elements that it starts.
RANGE = 16 << 20
#: Bytes read on at a time to finish a range's last element, and looked back for the key of an array.
MORE = 1 << 16

_KEY = re.compile(rb'"((?:[^"\\]|\\.)*)"\s*:\s*\Z')


class File:
    """Byte ranges of a file on any file system that Arrow opens (local, HDFS, S3, GCS)."""

    def __init__(self, path: str) -> None:
        uri = re.sub(r"^file:/+", "file:///", path)
        try:
            system, inner = pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)
        except pa.ArrowInvalid as unknown:
            raise ValueError(f"cannot read byte ranges of {path}; read it as a whole (split=None)") from unknown
        self.file = system.open_input_file(inner)
        self.size = self.file.size()

    def read(self, start: int, end: int) -> bytes:
        start, end = max(0, start), min(end, self.size)
        self.file.seek(start)
        return self.file.read(max(0, end - start))

    def escaped(self, at: int) -> bool:
        """Whether the byte at ``at`` follows an odd number of backslashes."""
        n = 0
        while at - n > 0:
            before = self.read(at - n - MORE, at - n)
            run = len(before) - len(before.rstrip(b"\\"))
            n += run
            if run < len(before):
                break
        return n % 2 == 1


def _marks(raw: bytes, escaped: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the quotes that no backslash escapes, and of all brackets and braces, strings' own among them."""
    data = np.frombuffer(raw, np.uint8)
    quotes = np.flatnonzero(data == 34)
    if len(quotes):
        other = np.where(data != 92, np.arange(len(data)), -1)
        last = np.maximum.accumulate(other)  # the last byte that is no backslash
        before = np.where(quotes > 0, last[np.maximum(quotes - 1, 0)], -1)
        run = quotes - 1 - before
        quotes = quotes[(run + (escaped & (before == -1))) % 2 == 0]
    return quotes, np.flatnonzero((data == 123) | (data == 125) | (data == 91) | (data == 93))


def _steps(raw: bytes, brackets: np.ndarray) -> np.ndarray:
    data = np.frombuffer(raw, np.uint8)[brackets]
    return np.where((data == 123) | (data == 91), 1, -1)


@dataclass(frozen=True)
class Range(InputPartition):
    """Bytes ``start`` to ``end`` of a file; whether it starts inside a string, how deep, and whether in the wanted array."""

    file: str
    start: int
    end: int
    quoted: bool = False
    depth: int = 0
    wanted: bool = False

    def outside(self, raw: bytes, escaped: bool) -> tuple[np.ndarray, np.ndarray]:
        """Brackets outside strings, and the depth after each."""
        quotes, brackets = _marks(raw, escaped)
        free = (np.searchsorted(quotes, brackets) + self.quoted) % 2 == 0
        brackets = brackets[free]
        return brackets, self.depth + np.cumsum(_steps(raw, brackets))

    def arrays(self, raw: bytes, before: bytes, brackets: np.ndarray, depths: np.ndarray, array: str) -> tuple[np.ndarray, list[bool]]:
        """Where top-level arrays open or close in the range, and whether the wanted one is open from there on."""
        data = np.frombuffer(raw, np.uint8)[brackets]
        turns = np.flatnonzero(((data == 91) & (depths == 2)) | ((data == 93) & (depths == 1)))
        places, open_ = brackets[turns], []
        for at, byte in zip(places.tolist(), data[turns].tolist(), strict=True):
            key = _KEY.search((before + raw[:at])[-MORE:]) if byte == 91 else None
            open_.append(key is not None and json.loads(b'"' + key[1] + b'"') == array)
        return places, open_


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each range: odd number of quotes, and for a start outside and inside a string the change of depth and the lowest."""
    for batch in batches:
        rows = []
        for path, start, end in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "end")), strict=True):
            file = File(path)
            raw = file.read(start, end)
            quotes, brackets = _marks(raw, file.escaped(start))
            steps, inside = _steps(raw, brackets), np.searchsorted(quotes, brackets) % 2
            out = [path, start, end, len(quotes) % 2 == 1]
            for case in (0, 1):
                run = np.cumsum(steps[inside == case])
                out += [int(run[-1]) if len(run) else 0, int(run.min(initial=0))]
            rows.append(out)
        names = ["file", "start", "end", "odd", "change_out", "low_out", "change_in", "low_in"]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows]) for i in range(len(names))], names)


def _turned(array: str):
    """Of ranges that get down to the top level: whether the wanted array is open at their end."""

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                file, own = File(r["file"]), Range(**r)
                raw = file.read(own.start, own.end)
                _, open_ = own.arrays(raw, file.read(own.start - MORE, own.start), *own.outside(raw, file.escaped(own.start)), array)
                rows.append((own.file, own.start, open_[-1] if open_ else None))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.bool_()))], ["file", "start", "open"])

    return turn


def _ranges(spark: SparkSession, path: str, array: str, size: int) -> list[Range]:
    """All ranges of the files under ``path`` with their states. What the driver sees grows with bytes / ``size``."""
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "length")
    starts = files.select("file", "length", F.explode(F.sequence(F.lit(0), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(size))).alias("start"))
    cut = starts.select("file", "start", F.least(F.col("start") + size, "length").alias("end"))
    sums = "file string, start long, end long, odd boolean, change_out long, low_out long, change_in long, low_in long"
    seen = cut.repartition("file", "start").mapInArrow(_summed, sums).collect()
    known, low = [], []
    for r in sorted(seen, key=lambda r: (r["file"], r["start"])):
        if r["start"] == 0:
            quoted, depth = False, 0
        known.append(Range(r["file"], r["start"], r["end"], quoted, depth))
        case = "in" if quoted else "out"
        if array and depth + r[f"low_{case}"] < 2:
            low.append(known[-1])
        quoted, depth = quoted ^ r["odd"], depth + r[f"change_{case}"]
    if not array:
        return [Range(**{**asdict(r), "wanted": True}) for r in known]
    kinds = "file string, start long, end long, quoted boolean, depth int, wanted boolean"
    turned = spark.createDataFrame([asdict(r) for r in low], kinds).repartition("file", "start").mapInArrow(_turned(array), "file string, start long, open boolean").collect() if low else []
    turns = {(r["file"], r["start"]): r["open"] for r in turned if r["open"] is not None}
    out, wanted = [], False
    for r in known:
        wanted = wanted and r.start > 0
        out.append(Range(**{**asdict(r), "wanted": wanted}))
        wanted = turns.get((r.file, r.start), wanted)
    return out


def elements_of(file: File, own: Range, array: str) -> Iterator[tuple[int, bytes]]:
    """Place and text of each object of the wanted array that starts in a range; the last is read on to its end."""
    raw = file.read(own.start, own.end)
    escaped, level = file.escaped(own.start), 2 if array else 1
    brackets, depths = own.outside(raw, escaped)
    data = np.frombuffer(raw, np.uint8)[brackets]
    opens = brackets[(data == 123) & (depths == level + 1)]
    if array:
        places, open_ = own.arrays(raw, file.read(own.start - MORE, own.start), brackets, depths, array)
        since = np.searchsorted(places, opens) - 1
        opens = opens[np.where(since >= 0, np.array([*open_, False])[since], own.wanted)]
    closes = brackets[(data == 125) & (depths == level)]
    ends = np.searchsorted(closes, opens)
    for at, end in zip(opens.tolist(), ends.tolist(), strict=True):
        if end < len(closes):
            yield own.start + at, raw[at : int(closes[end]) + 1]
        else:
            yield own.start + at, _to_end(file, own.start + at, raw[at:])


def _to_end(file: File, start: int, text: bytes) -> bytes:
    """The object that starts at ``start`` and goes on behind ``text``."""
    at, state = start + len(text), Range("", 0, 0)
    parts, escaped = [text], False
    while True:
        brackets, depths = state.outside(parts[-1], escaped)
        closed = np.flatnonzero(depths == 0)
        if len(closed):
            parts[-1] = parts[-1][: int(brackets[closed[0]]) + 1]
            return b"".join(parts)
        quotes, _ = _marks(parts[-1], escaped)
        state = Range("", 0, 0, state.quoted ^ (len(quotes) % 2 == 1), int(depths[-1]) if len(depths) else state.depth)
        escaped = file.escaped(at)
        parts.append(file.read(at, at + MORE))
        if not parts[-1]:
            raise ValueError(f"the document ends within the object at byte {start}")
        at += len(parts[-1])


class JsonArraySource(DataSource):
    """``spark.read.format("json_array")``: one row an object of a JSON array, ``file, position, value``. Options: ``ranges`` (as
    ``read_array`` makes them) and ``array`` (the top-level key; none: the document is the array)."""

    @classmethod
    def name(cls) -> str:
        return "json_array"

    def schema(self) -> str:
        return "file string, position long, value string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(json.loads(self.options["ranges"]), self.options.get("array", ""))


class _Reader(DataSourceReader):
    def __init__(self, ranges: list[dict], array: str) -> None:
        self.ranges, self.array = ranges, array

    def partitions(self) -> list[Range]:
        return [Range(**r) for r in self.ranges]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        names, rows, size = ["file", "position", "value"], [], 0
        for at, text in elements_of(File(partition.file), partition, self.array):
            rows.append((partition.file, at, text.decode()))
            size += len(text)
            if size > MORE * 16:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows]) for i in range(3)], names)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows]) for i in range(3)], names)


def read_array(spark: SparkSession, path: str, array: str = "", size: int = RANGE) -> DataFrame:
    """``file, position, value``: the objects of one array of the JSON documents at ``path`` (a file, a folder or a pattern), as texts,
    with their byte offset. ``array`` names the top-level key that holds it; without it the document itself is the array.

    A document is read by as many tasks as it has ranges of ``size`` bytes, whatever its layout in lines. Objects may hold any nesting,
    escapes and brackets in strings; what is no object in the array is left out, as are arrays of that name further down. An empty
    file has no objects; a document that ends within one is an error.
    """
    ranges = _ranges(spark, path, array, size)
    if not ranges:
        return spark.createDataFrame([], "file string, position long, value string")
    spark.dataSource.register(JsonArraySource)
    return spark.read.format("json_array").option("ranges", json.dumps([asdict(r) for r in ranges])).option("array", array).load()
