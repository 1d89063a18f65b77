"""Small helpers shared by the text operators."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from walkgrid.session import materialize

Batches = Iterator[pa.RecordBatch]


def raw_texts(array: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a text column, without decoding; null stays null."""
    return array.cast(pa.binary()).to_pylist()


def slices(batch: pa.RecordBatch, name: str, size: int) -> Batches:
    """A batch in slices of about ``size`` bytes of one column, a row at least."""
    at = np.cumsum(pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // size
    cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(a, b - a)


def with_columns_in_arrow(
    df: DataFrame, make: Callable[[pa.RecordBatch], dict[str, pa.Array]], fields: list[T.StructField], sized_by: str | None = None, slice_bytes: int = 4 << 20
) -> DataFrame:
    """``df`` with the columns that ``make`` computes of each batch; a column of the same name is replaced. With ``sized_by``, a
    text column, a batch is handled and handed on in slices of about ``slice_bytes`` of it, so that no more results are held."""
    names = [f.name for f in fields]
    kept = [f for f in df.schema.fields if f.name not in names]

    def run(batches: Batches) -> Batches:
        for whole in batches:
            for batch in slices(whole, sized_by, slice_bytes) if sized_by and whole.num_rows else [whole]:
                if batch.num_rows:
                    made = make(batch)
                    yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *(made[n] for n in names)], [*(f.name for f in kept), *names])

    return df.mapInArrow(run, T.StructType([*kept, *fields]))


#: Rows of a file of a narrow table whose number of rows is known.
FILE_ROWS = 1 << 18


def table(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back, with the shuffle files of the write let go at once. With ``rows``, a bound
    on a narrow table's rows, it is dealt to as few files as they need: a small table is not left as a file from each task."""
    if rows is not None:
        df = df.repartition(max(1, -(-rows // FILE_ROWS)))
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name, None)
    conf.set(name, "true")
    try:
        return materialize(df, label)
    finally:
        conf.unset(name) if before is None else conf.set(name, before)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it, such that ``df`` has no such column (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``k2, k1, doc_id, text``: two numbers that name a row (equal for rows equal in id and text), first in order of a
    numeric id. Ids that are null or no numbers are hashed."""
    number = F.coalesce(F.expr(f"try_cast(`{doc_id}` as bigint)"), F.xxhash64(F.coalesce(F.col(doc_id).cast("string"), F.lit("\0"))))
    return docs.select(number.alias("k2"), F.xxhash64(F.col(text)).alias("k1"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads 64-bit values (two xor-shift-multiply rounds)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


_PIECE, _SPACE = 1 << 20, re.compile(rb"[\x20\x09-\x0D]")
_ODD = np.uint64(0x5851F42D4C957F2D)
_TABLES: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    if len(_TABLES.get("up", ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for name, base in (("up", int(_ODD)), ("down", pow(int(_ODD), -1, 1 << 64))):
            table = np.ones(size, np.uint64)
            done, step = 1, base
            while done < size:  # doubling: table[done:2*done] = table[:done] * base**done
                table[done : 2 * done] = table[:done] * np.uint64(step)
                done, step = 2 * done, step * step % (1 << 64)
            _TABLES[name] = table
    return _TABLES["up"][:n], _TABLES["down"][:n]


def word_pieces(text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``words`` of a text piece by piece; pieces end at white space, so that the tables of powers and all arrays stay small."""
    at = 0
    while at < len(text):
        found = _SPACE.search(text, at + _PIECE) if len(text) - at > 2 * _PIECE else None
        end = found.start() if found else len(text)
        h, start, stop = _words(text[at:end])
        yield h, start + at, stop + at
        at = end


def words(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash, start and end (bytes) of each word (``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased) of a text, in order."""
    if len(text) > 2 * _PIECE:
        return tuple(np.concatenate(x) for x in zip(*word_pieces(text), strict=True))
    return _words(text)


def _words(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer(text.lower(), np.uint8)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.diff(np.concatenate(([True], space, [True])).view(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = powers(len(raw) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)])))
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), start, end


def word_hashes(text: bytes) -> np.ndarray:
    return words(text)[0]


def shingle_hashes(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of ``size`` consecutive words; fewer words, but not none: of the whole sequence."""
    if not len(words):
        return words
    n = min(size, len(words))
    value = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        value = value * np.uint64(0xD1342543DE82EF95) + words[i : len(words) - n + 1 + i]
    return np.unique(mix(value))


def text_shingles(text: bytes, size: int = 5) -> np.ndarray:
    """``shingle_hashes`` of a text's words. A long text is hashed piece by piece, each with the last words of the one before, so that
    beside one piece only the distinct shingles are held."""
    if len(text) <= 2 * _PIECE:
        return shingle_hashes(word_hashes(text), size)
    found, last, n = [], np.empty(0, np.uint64), 0
    for h, _, _ in word_pieces(text):
        n += len(h)
        last = np.concatenate((last, h))
        if len(last) >= size:
            found.append(shingle_hashes(last, size))
            last = last[len(last) - size + 1 :]
    return shingle_hashes(last, size) if n < size else np.unique(np.concatenate(found))


#: Bytes of texts whose words are taken at once: the arrays stay in a core's cache.
JOINED = 1 << 17


def joined(texts: list[bytes | None]) -> Iterator[list[bytes]]:
    """The texts, null as empty, in lists of about ``JOINED`` bytes, a text at least."""
    some, size = [], 0
    for t in texts:
        some.append(t or b"")
        size += len(some[-1])
        if size >= JOINED or len(some) == 1 << 15:
            yield some
            some, size = [], 0
    if some:
        yield some


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``words`` of several texts, one after the other with a line end between: hash, start and end of each word; the number of its
    text; the first byte of each text."""
    base = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    h, start, end = words(b"\n".join(texts))
    return h, start, end, np.searchsorted(base, start, "right") - 1, base


def by_owner(value: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Order by owner (a number from 0), then value."""
    order = np.argsort(value)
    small = owner.astype(np.min_scalar_type(owner.max(initial=0)))  # sorted by its digits
    return order[np.argsort(small[order], kind="stable")]


def shingle_sets(texts: list[bytes | None], size: int = 5) -> Iterator[np.ndarray]:
    """``text_shingles`` of each text, in order; short texts are hashed together."""
    for some in joined(texts):
        if len(some) == 1 or len(some[-1]) >= JOINED:  # a long text is the last of its list
            some, last = some[:-1], some[-1]
        else:
            last = None
        if some:
            h, _, _, of, _ = words_of(some)
            n = np.bincount(of, minlength=len(some))
            first = np.cumsum(n) - n
            value = np.full(max(0, len(h) - size + 1), size, np.uint64)
            for i in range(size):
                value = value * np.uint64(0xD1342543DE82EF95) + h[i : i + len(value)]
            whole = of[: len(value)] == of[size - 1 :][: len(value)]
            value, of = mix(value[whole]), of[: len(value)][whole]
            order = by_owner(value, of)
            value, of = value[order], of[order]
            new = np.append(True, (value[1:] != value[:-1]) | (of[1:] != of[:-1]))[: len(value)]
            value, of = value[new], of[new]
            ends = np.cumsum(np.bincount(of, minlength=len(some))).tolist()
            for i, (a, b) in enumerate(zip([0, *ends], ends, strict=False)):
                yield value[a:b] if n[i] >= size else shingle_hashes(h[first[i] : first[i] + n[i]], size)
        if last is not None:
            yield text_shingles(last, size)
