"""Packing documents into fixed-length training sequences: best fit, then swap-based local search."""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections import defaultdict
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from walkgrid.llm.common import fresh, table


CAPACITY = 2048
#: Pieces that one packing task holds at most, about.
GROUP = 3_000
#: Stretches of which a worker remembers the ids: about 200 bytes each.
MEMO = 800_000

#: Texts of these characters only are split at single spaces, each of which opens a new word of the vocabulary's pattern.
_PLAIN = re.compile(r"[\t\n\r -~À-ÖØ-öø-ÿ]*")
#: Fixed value: that pattern.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class _Memo(dict):
    """Little-endian 32-bit ids of what follows a space up to the next one; a bounded memory of them."""

    def __init__(self, encode) -> None:
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = array("I", self.encode(" " + word)).tobytes()
        if len(self) < MEMO:
            self[word] = ids
        return ids


class Encoder:
    """Ids that ``tokenizers`` gives for a byte-level BPE file (special tokens not added), as little-endian 32-bit bytes.

    Texts of plain characters without double spaces are cut before each space, where the vocabulary's pattern always starts
    a new word, and the ids of a stretch are remembered. All other texts, and those holding an added token's string, go to
    the tokenizer whole.
    """

    def __init__(self, path: str) -> None:
        self.whole = Tokenizer.from_file(path)
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        vocabulary = json.loads(Path(path).read_text(encoding="utf-8"))["model"]["vocab"]
        byte = {c: b for b, c in _byte_letters().items()}
        ranks = {bytes(byte[c] for c in w): i for w, i in vocabulary.items() if w not in self.added}
        self.plain = tiktoken.Encoding("plain", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.memo = _Memo(self.plain)

    def __call__(self, text: str) -> bytes:
        if "  " not in text and _PLAIN.fullmatch(text) and not any(a in text for a in self.added):
            first, *rest = text.split(" ")
            return b"".join([array("I", self.plain(first)).tobytes(), *map(self.memo.__getitem__, rest)])
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte: its own where printable, else from U+0100 up."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_ENCODERS: dict[str, Encoder] = {}


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Starts and lengths of the pieces of ``n`` ids: one, or pieces of ``capacity`` of which the first takes the rest."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((a, capacity) for a in range(first, n, capacity))]


def pieces(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids: ``doc_id, piece, start, length, ids_crc32`` and, on request, ``ids``.

    A document is the ids of its text and ``end_id``; a null text counts as empty, so every row gives one piece at least.
    Only documents longer than ``capacity`` are cut; their first piece may be shorter, all others are full. Repeated rows
    give repeated pieces. Narrow: one pass over the texts, no shuffle. The path is read on the executors.
    """
    fields = [T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("piece", T.IntegerType()), *(T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32"))]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        if tokenizer_path not in _ENCODERS:
            _ENCODERS[tokenizer_path] = Encoder(tokenizer_path)
        encode = _ENCODERS[tokenizer_path]
        for batch in batches:
            at, rows, ids = [], [], []
            for i, t in enumerate(batch.column("_text").to_pylist()):
                raw = (encode(t) if t else b"") + end
                for k, (start, length) in enumerate(cut(len(raw) // 4, capacity)):
                    own = raw[4 * start : 4 * (start + length)]
                    at.append(i)
                    rows.append((k, start, length, zlib.crc32(own)))
                    if with_ids:
                        ids.append(np.frombuffer(own, "<i4"))
            if rows:
                k, start, length, crc = zip(*rows, strict=True)
                arrays = [batch.column("_id").take(pa.array(at)), pa.array(k, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays + [pa.array(ids, pa.list_(pa.int32()))] * with_ids, [f.name for f in fields])

    return docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).mapInArrow(run, T.StructType(fields))


def pack_lengths(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins (lists of positions in ``lengths``) by best fit of the longest first, then local search until no bin empties."""
    bins: list[list[int]] = []
    free: list[int] = []
    by_free: dict[int, list[int]] = defaultdict(list)
    open_spaces = 0  # bit f: some bin has f free
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        fits = open_spaces >> n
        if fits:
            space = n + (fits & -fits).bit_length() - 1
            b = by_free[space].pop()
            if not by_free[space]:
                open_spaces ^= 1 << space
        else:
            b, space = len(bins), capacity
            bins.append([])
            free.append(0)
        bins[b].append(i)
        free[b] = space - n
        if free[b]:
            by_free[free[b]].append(b)
            open_spaces |= 1 << free[b]
    return [b for b in _Search(lengths, bins, free, capacity).run() if b]


#: Widths of the local search. Pieces of a bin that are tried in pairs; pieces of one length, bins and other givers that are looked
#: at for an exchange; the largest gain of one exchange, and of one for two; steps spent on one bin; bins in a row that
#: may withstand before the search ends. Wider searches take longer and empty a few more bins.
PAIRED, ALIKE, BINS, GIVERS, GAIN, GAIN_OF_TWO, STEPS, TRIES = 12, 64, 200, 8, 256, 8, 400, 8


class _Search:
    """Empties the emptiest bins. Each step moves a piece out of the victim, or exchanges one or two of its pieces for one of
    another bin (or one for two), so that the other bin gets fuller and the sum of squared fills grows. A bin that cannot be
    emptied stays, and the search goes on with the next."""

    def __init__(self, lengths: list[int], bins: list[list[int]], free: list[int], capacity: int) -> None:
        self.n, self.bins, self.free, self.capacity = lengths, bins, free, capacity
        self.by_length: dict[int, set[int]] = defaultdict(set)  #: pieces in underfull bins, by length
        self.home: dict[int, int] = {}
        for b, f in enumerate(free):
            if f:
                for i in bins[b]:
                    self.home[i] = b
                    self.by_length[lengths[i]].add(i)

    def _put(self, i: int, b: int | None) -> None:
        old = self.home[i]
        self.bins[old].remove(i)
        self.free[old] += self.n[i]
        self.bins[b].append(i)
        self.free[b] -= self.n[i]
        self.home[i] = b

    def _swap(self, out: list[int], into: list[int], victim: int, other: int) -> None:
        for i in into:
            self._put(i, victim)
        for i in out:
            self._put(i, other)

    def _better(self, victim: int, most: int, avoid: int = -1) -> tuple[list[int], list[int], int] | None:
        """Pieces of the victim to give away, the piece to take instead, and the bin, which is no emptier; the largest gain that
        is found."""
        own = sorted(self.bins[victim], key=lambda i: -self.n[i])
        pairs = [(i, j) for k, i in enumerate(own[:PAIRED]) for j in own[k + 1 : PAIRED]]
        for gain in range(most, 0, -1):
            for out in [(i,) for i in own] + pairs:
                want = sum(self.n[i] for i in out) - gain
                for j in sorted(self.by_length.get(want, ()))[:ALIKE]:
                    if self.home[j] not in (victim, avoid) and gain <= self.free[self.home[j]] <= self.free[victim]:
                        return list(out), [j], self.home[j]
        return None

    def _two(self, victim: int, targets: list[int]) -> tuple[list[int], list[int], int] | None:
        """One of the victim's pieces for two smaller ones of a bin."""
        for i in sorted(self.bins[victim], key=lambda i: -self.n[i]):
            for b in targets:
                if b == victim or not self.free[b]:
                    continue
                seen: dict[int, int] = {}
                for j in self.bins[b]:
                    for gain in range(min(self.free[b], GAIN_OF_TWO), 0, -1):
                        k = seen.get(self.n[i] - gain - self.n[j])
                        if k is not None:
                            return [i], [j, k], b
                    seen[self.n[j]] = j
        return None

    def run(self) -> list[list[int]]:
        under = [b for b, f in enumerate(self.free) if f]
        withstood: set[int] = set()
        while len(under) > 1 and len(withstood) < TRIES:
            room = sum(self.free[b] for b in under)
            victim = max((b for b in under if b not in withstood), key=lambda b: self.free[b], default=None)
            if victim is None or room < self.capacity:
                break  # the others cannot take any bin in, whatever is exchanged
            for _ in range(STEPS):
                moved = False
                for i in sorted(self.bins[victim], key=lambda i: -self.n[i]):
                    fits = [b for b in under if b != victim and self.free[b] >= self.n[i]]
                    if fits:
                        self._put(i, min(fits, key=lambda b: self.free[b]))
                        moved = True
                if not self.bins[victim] or moved:
                    if not self.bins[victim]:
                        break
                    continue
                best = max((self.free[b] for b in under if b != victim), default=0)
                step = self._better(victim, min(best, GAIN)) or self._two(victim, sorted(under, key=lambda b: -self.free[b])[:BINS])
                giver = victim
                if step is None:  # two other bins: the emptier one gets emptier, until it can take a piece of the victim
                    for giver in sorted((b for b in under if b != victim and self.free[b]), key=lambda b: -self.free[b])[:GIVERS]:
                        step = self._better(giver, min(best, GAIN), victim)
                        if step:
                            break
                if step is None:
                    break
                self._swap(*step[:2], giver, step[2])
            if self.bins[victim]:
                withstood.add(victim)
            else:
                withstood.clear()  # its pieces have made other bins fuller
            under = [b for b in under if self.free[b] and self.bins[b]]
        return self.bins


def _packer(names: dict[str, str], length: str, capacity: int, n_round: int, last: bool):
    """Packs one group; the sequences it could not fill stay open unless the round is the last."""

    def one(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(names["row"], ignore_index=True).drop(columns=names["group"])
        lengths = part[length].astype(int).tolist()
        sequence, offset, unfilled = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64), np.zeros(len(part), bool)
        for k, own in enumerate(pack_lengths(lengths, capacity)):
            fill = 0
            for i in own:
                sequence[i], offset[i] = (n_round << 56) + (int(key[0]) << 24) + k, fill
                fill += lengths[i]
            unfilled[own] = not last and fill < capacity
        return part.assign(**{"sequence_id": sequence, "offset": offset, names["open"]: unfilled})

    return one


def pack(found: DataFrame, capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """``found`` with ``sequence_id`` and ``offset``: sequences of at most ``capacity`` ids, as few as local search finds.

    Each row is numbered, in a written table, and dealt by its number to groups of about ``GROUP`` rows, so that repeated rows are
    dealt like all others; each group is packed by a task of its own. Full sequences are then final; what a group could not fill (a
    few sequences) goes on to the next, smaller round of groups until one group is left, so no row is dropped and no group grows
    with the table. Where a round closes less than a tenth of its rows (few, long pieces, of which hardly any fill a sequence), no
    further round would, and its groups stay as they are packed: every row is in a sequence, only the search across groups ends.
    Lengths must lie between 1 and ``capacity``. Ties and repeated rows are separate pieces. An empty table gives no rows. Columns
    named as an output are replaced, all others stay.
    """
    columns = [c for c in found.columns if c not in ("sequence_id", "offset")]
    names = {n: fresh(found, n) for n in ("row", "group", "open")}
    rest = table(found.select(*columns, F.monotonically_increasing_id().alias(names["row"])), "pieces")
    fields = [*rest.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    schema, done, n_round, rows = T.StructType([*fields, T.StructField(names["open"], T.BooleanType())]), None, 0, rest.count()
    while True:
        groups, last_round = max(1, -(-rows // GROUP)), rows <= GROUP
        dealt = rest.withColumn(names["group"], F.pmod(F.xxhash64(names["row"], F.lit(n_round)), F.lit(groups)).cast("int"))
        packed = dealt.groupBy(names["group"]).applyInPandas(_packer(names, length, capacity, n_round, last_round), schema)
        packed = table(packed, "packed", rows)
        closed = packed.filter(~F.col(names["open"])).drop(*names.values())
        done = closed if done is None else done.unionByName(closed)
        if last_round:
            return done
        rest = packed.filter(names["open"]).select(*columns, names["row"])
        before, rows, n_round = rows, rest.count(), n_round + 1
        if rows > 0.9 * before:
            return done.unionByName(packed.filter(names["open"]).drop(*names.values()))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pack_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """All documents cut and packed; see ``pieces`` and ``pack``."""
    return pack(pieces(docs, path or tokenizer_path()))


