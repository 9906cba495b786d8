"""Packing token pieces into as few sequences as possible, by swap-based local search.

Pieces are dealt evenly over partitions. Each partition fills sequences best-fit first, then
searches: documents are exchanged one for one or two for one, or moved, between underfull
sequences wherever that makes the sum of squared fills larger. Full sequences get fuller and
thin ones thinner until they are empty. The thinnest sequences of every partition are opened
again and packed together in a second round, so that partitions do not each leave a gap.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_right
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.byte_tokens import tokens_of
from orderloom.llm.common import quoted
from orderloom.session import settle

CAPACITY = 2048
END_ID = 0
PIECES_PER_PARTITION = 40_000
#: Of every partition, so many of its thinnest sequences go to the second round ...
REOPENED = 16
#: ... which packs those of so many partitions together.
PARTITIONS_TOGETHER = 500
#: Sequences the search looks at on either side of an exchange.
NEIGHBOURS = 64


def cut(length: int, capacity: int) -> list[int]:
    """Piece lengths: all full but the first."""
    first = length % capacity or min(length, capacity)
    return [first] + [capacity] * ((length - first) // capacity)


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every row's whole text and an end id.

    NULL text is the empty text, which is one piece of the end id. Repeated rows give repeated
    pieces, a NULL id stays NULL.
    """
    with open(tokenizer_path, "rb") as file:
        blob = docs.sparkSession.sparkContext.broadcast(file.read())
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int32())] * with_ids
    source = docs.select(quoted(id_col).cast("bigint").alias("id"), quoted(text_col).alias("text"))
    end = END_ID.to_bytes(4, "little")

    def run(batches):
        tokens = tokens_of(blob.value)
        for batch in batches:
            ids, texts = (c.to_pylist() for c in batch.columns)
            rows = []
            for doc_id, packed in zip(ids, tokens.encode_batch([t or "" for t in texts]), strict=True):
                packed, start = packed + end, 0
                for piece, length in enumerate(cut(len(packed) // 4, capacity)):
                    part = packed[4 * start : 4 * (start + length)]
                    row = (doc_id, piece, start, length, zlib.crc32(part))
                    rows.append((*row, np.frombuffer(part, "<i4")) if with_ids else row)
                    start += length
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return source.mapInArrow(run, schema + ", ids array<int>" * with_ids)


class _Bins:
    """Sequences of one partition: which pieces each holds, and how full it is."""

    def __init__(self, lengths: Sequence[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.held: list[list[int]] = []
        self.fill: list[int] = []

    def best_fit(self) -> None:
        """Longest first, each into the fullest sequence it fits."""
        by_room: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        rooms = 0  # bit r: some sequence has room r
        for piece in sorted(range(len(self.lengths)), key=lambda p: (-self.lengths[p], p)):
            size = self.lengths[piece]
            fitting = rooms >> size
            if fitting:
                room = size + (fitting & -fitting).bit_length() - 1
                target = by_room[room].pop()
                if not by_room[room]:
                    rooms &= ~(1 << room)
            else:
                room, target = self.capacity, len(self.held)
                self.held.append([])
                self.fill.append(0)
            self.held[target].append(piece)
            self.fill[target] += size
            left = room - size
            if left:
                by_room[left].append(target)
                rooms |= 1 << left

    def least(self) -> int:
        return math.ceil(sum(self.lengths) / self.capacity)

    def count(self) -> int:
        return sum(f > 0 for f in self.fill)

    def _exchange(self, fuller: int, thinner: int) -> bool:
        """The move or exchange that fills ``fuller`` most from ``thinner``; False if there is none."""
        room, size = self.capacity - self.fill[fuller], self.lengths
        give = sorted(self.held[thinner], key=size.__getitem__)
        sizes = [size[p] for p in give]
        best, out, into = 0, (), ()
        singles = [((), 0)] + [((p,), size[p]) for p in self.held[fuller]]
        if at := bisect_right(sizes, room):  # move
            best, out, into = sizes[at - 1], (), (give[at - 1],)
        for pieces, freed in singles[1:]:  # one for one
            at = bisect_right(sizes, room + freed)
            if at and sizes[at - 1] - freed > best:
                best, out, into = sizes[at - 1] - freed, pieces, (give[at - 1],)
        for pieces, freed in singles:  # two for one, or for none
            low, high = 0, len(give) - 1
            while low < high:
                total = sizes[low] + sizes[high]
                if total > room + freed:
                    high -= 1
                else:
                    if total - freed > best:
                        best, out, into = total - freed, pieces, (give[low], give[high])
                    low += 1
        for i, a in enumerate(self.held[fuller]):  # one for two
            for b in self.held[fuller][i + 1 :]:
                freed = size[a] + size[b]
                at = bisect_right(sizes, room + freed)
                if at and sizes[at - 1] - freed > best:
                    best, out, into = sizes[at - 1] - freed, (a, b), (give[at - 1],)
        if not best:
            return False
        for pieces, source, target in ((out, fuller, thinner), (into, thinner, fuller)):
            for p in pieces:
                self.held[source].remove(p)
                self.held[target].append(p)
                self.fill[source] -= size[p]
                self.fill[target] += size[p]
        return True

    def search(self) -> None:
        """Fill the fuller from the thinner while a sequence can still be saved.

        Every exchange makes the sum of squared fills larger: the fuller sequence gains what
        the thinner one loses. So the search ends.
        """
        while self.count() > self.least():
            open_ = sorted((b for b, f in enumerate(self.fill) if 0 < f < self.capacity), key=lambda b: (self.fill[b], b))
            changed = False
            for thin in open_[:NEIGHBOURS]:
                for full in reversed(open_):
                    if full == thin or self.fill[thin] == 0 or self.fill[full] < self.fill[thin]:
                        break
                    while self.fill[thin] and self._exchange(full, thin):
                        changed = True
                if self.fill[thin] == 0:
                    break
            if not changed:
                return


def pack_lengths(lengths: Sequence[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Pieces of each sequence, in order; every piece is at most ``capacity`` long."""
    bins = _Bins(lengths, capacity)
    bins.best_fit()
    bins.search()
    return [sorted(h, key=lambda p: (-lengths[p], p)) for h in bins.held if h]


def _pack_part(table: pa.Table, capacity: int, reopen: int) -> pa.Table:
    """Packs the rows of one part; ``again`` marks sequences that may be opened again."""
    # Any order of arrival packs the same way.
    order = [("length", "descending"), *((c, "ascending") for c in ("doc_id", "piece", "start", "ids_crc32"))]
    table = table.sort_by(order)
    lengths, part = table["length"].to_pylist(), table["part"][0].as_py()
    sequences = pack_lengths(lengths, capacity)
    fills = [sum(lengths[p] for p in s) for s in sequences]
    thin = sorted((i for i, f in enumerate(fills) if f < capacity), key=lambda i: (fills[i], i))
    thin = set(thin[:reopen])
    sequence = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    again = np.zeros(len(lengths), bool)
    for i, pieces in enumerate(sequences):
        at = 0
        for p in pieces:
            sequence[p], offset[p], again[p] = (part << 32) + i, at, i in thin
            at += lengths[p]
    for name, values in (("sequence_id", sequence), ("offset", offset), ("again", again)):
        table = table.append_column(name, pa.array(values))
    return table


def pack(pieces: DataFrame, capacity: int = CAPACITY, per_partition: int = PIECES_PER_PARTITION) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces as ``token_pieces`` makes them.

    Sequence ids are unique, not dense. No pieces give no rows.
    """
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    pieces = settle(pieces.select(*columns))
    partitions = max(1, math.ceil(pieces.count() / per_partition))
    kinds = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part bigint"
    schema = kinds + ", sequence_id bigint, offset bigint, again boolean"
    part = F.pmod(F.xxhash64(*columns), F.lit(partitions)).cast("bigint")

    def packed(rows: DataFrame, parts: int, reopen: int) -> DataFrame:
        dealt = rows.repartition(parts, "part").groupBy("part")
        return dealt.applyInArrow(lambda table: _pack_part(table, capacity, reopen), schema)

    first = settle(packed(pieces.withColumn("part", part), partitions, REOPENED if partitions > 1 else 0))
    together = math.ceil(partitions / PARTITIONS_TOGETHER)
    # Below zero, so that second-round ids differ from all of the first.
    group = (-1 - F.floor(F.col("part") / PARTITIONS_TOGETHER)).cast("bigint")
    rest = first.where("again").select(*columns, group.alias("part"))
    out = [*columns, "sequence_id", "offset"]
    return first.where("not again").select(*out).unionByName(packed(rest, together, 0).select(*out))


def assemble(packed: DataFrame, pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids): the token ids of every sequence, from pieces made with ids."""
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    ids = pieces.dropDuplicates(key).select(*key, "ids")
    match = [F.col(f"p.{k}").eqNullSafe(F.col(f"t.{k}")) for k in key]
    rows = packed.alias("p").join(ids.alias("t"), match).select("p.sequence_id", "p.offset", "p.doc_id", "t.ids")
    ordered = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return rows.groupBy("sequence_id").agg(ordered.alias("parts")).select(
        "sequence_id",
        F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"),
        F.transform("parts", lambda p: p["doc_id"]).alias("doc_ids"),
    )
