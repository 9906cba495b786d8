"""Removal of byte strings that occur more than once, by merged Burrows-Wheeler transforms.

A byte goes if a string of ``length`` bytes around it starts anywhere else too. To find those
without sorting every suffix of the corpus, each window of ``length`` bytes names one anchor
in it, the place of the smallest hash of ``gram`` bytes. Equal windows name the same place, so
every repeat shows between anchors of one gram, and only anchors whose gram occurs again are
looked at. Anchors with equal surroundings are one class; a class of two is all repeat.

Classes of a gram meet in one task as shards. A shard's suffixes (what follows each anchor)
are sorted once; the shards are then merged by refining their interleave word by word, and
where a block splits the common prefix of its neighbours is known. From the merged order, the
preceding byte of every suffix - its Burrows-Wheeler symbol - extends all matches to the left
one byte at a time; a stable split by that byte keeps the order, and neighbours in an interval
give the longest match of a place. A place whose left and right match add up to ``length``
lies in a repeat.

Grams with very many different surroundings are not brought together: their windows are
counted one by one by 128-bit hashes, which aggregate before they shuffle.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import WORD, quoted, shielded, sliced, whole, without
from orderloom.session import scratch_dir, settle
from orderloom.sources import files

LENGTH = 400
GRAM = 100
#: Bytes of text a worker hashes at a time.
SEGMENT = 1 << 18
#: What a word is, in bytes.
WORDS = re.compile(WORD.encode())
#: Contexts of a shard, of a merge, and of one gram beyond which its windows are counted instead.
SHARD = 4_096
TOGETHER = 16_384
MOST_TOGETHER = 200_000
#: Never part of UTF-8, so it equals no byte of a text.
PAD = 0xFF
U64 = (1 << 64) - 1


@dataclass(frozen=True)
class Shape:
    """A window, and the gram its anchor is the start of; so much of the text on either side counts."""

    length: int = LENGTH
    gram: int = GRAM

    @property
    def left(self) -> int:
        return self.length - self.gram

    @property
    def grams(self) -> int:
        return self.length - self.gram + 1


def _mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hashes:
    """Polynomial hashes of any stretch of a byte string, modulo 2**64."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.value_of = rng.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(rng.integers(1 << 60, 1 << 62)) * 8 + 5
        self.inverse = pow(self.base, -1, 1 << 64)
        self.power = self.unpower = np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        if len(self.power) < size:
            size = max(size, 1 << 16)
            ones = np.ones(size, np.uint64)
            ones[1:] = self.base
            self.power = np.multiply.accumulate(ones)
            ones[1:] = self.inverse
            self.unpower = np.multiply.accumulate(ones)

    def prefixes(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.value_of[data] * self.power[: len(data)], out=sums[1:])
        return sums

    def between(self, sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (sums[end] - sums[begin]) * self.unpower[begin]


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours: running minima from both ends of blocks."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    rows = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors_of(texts: list[bytes], shape: Shape, hashes: Hashes) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, position, gram hash, context hash) arrays: the places named by the windows of every text."""
    pending: list[tuple[int, int, int, int]] = []  # text, first byte, windows from, windows to
    size = 0
    for i, text in enumerate(texts):
        windows = len(text) - shape.length + 1
        for start in range(0, max(windows, 0), SEGMENT):
            pending.append((i, max(0, start - shape.length), start, min(windows, start + SEGMENT)))
            size += pending[-1][3] - pending[-1][1]
            if size >= SEGMENT:
                yield _anchors_together(texts, pending, shape, hashes)
                pending, size = [], 0
    if pending:
        yield _anchors_together(texts, pending, shape, hashes)


def _anchors_together(texts, pending, shape: Shape, hashes: Hashes) -> tuple[np.ndarray, ...]:
    parts = [np.frombuffer(texts[i], np.uint8)[low : to + 2 * shape.length] for i, low, _, to in pending]
    sizes = np.array([len(p) for p in parts])
    bases = np.cumsum(sizes) - sizes
    data = np.concatenate(parts)
    sums = hashes.prefixes(data)
    starts = np.arange(len(data) - shape.gram + 1)
    order = _mix(hashes.between(sums, starts, starts + shape.gram))
    # Smallest by the upper bits, the first of equals by the place in the lower ones.
    smallest = sliding_minimum(order & np.uint64(U64 ^ 0xFFFFFFFF) | starts.astype(np.uint64), shape.grams)
    named = (smallest & np.uint64(0xFFFFFFFF)).astype(np.int64)
    found = []
    for n, (i, low, begin, to) in enumerate(pending):
        window = slice(bases[n] + begin - low, bases[n] + to - low)
        places = named[window]
        places = places[np.concatenate([[True], places[1:] != places[:-1]])]
        if begin:  # a segment further on in the text: its first place may be known
            before = named[bases[n] + begin - low - 1] if begin > low else -1
            places = places[places != before]
        found.append(places)
    counts = [len(f) for f in found]
    at = np.concatenate(found)
    part = np.repeat(np.arange(len(found)), counts)
    text = np.array([p[0] for p in pending])[part]
    position = at - bases[part] + np.array([p[1] for p in pending])[part]
    length = np.array([len(texts[p[0]]) for p in pending])[part]
    left = np.minimum(position, shape.left)
    right = np.minimum(length - position, shape.length)
    context = _mix(hashes.between(sums, at - left, at + right) + (left * 4096 + right).astype(np.uint64))
    return text, position, _mix(order[at] + np.uint64(1)), context


def _anchor_rows(keyed: DataFrame, shape: Shape) -> DataFrame:
    """(k1, k2, position, gram, context) of every anchor of every row."""

    def run(batches):
        hashes = Hashes(1)
        for batch in (part for batch in batches for part in sliced(batch, 2)):
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for text, position, gram, context in anchors_of(batch.column(2).to_pylist(), shape, hashes):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1[text]), pa.array(k2[text]), pa.array(position), pa.array(gram.view(np.int64)), pa.array(context.view(np.int64))],
                    names=["k1", "k2", "position", "gram", "context"],
                )

    schema = "k1 bigint, k2 bigint, position bigint, gram bigint, context bigint"
    return keyed.select("k1", "k2", F.col("text").cast("binary")).mapInArrow(run, schema)


# Merging


def sort_shard(words: np.ndarray, group: np.ndarray) -> np.ndarray:
    """The order of one shard's suffixes, group by group."""
    return np.lexsort((*words.T[::-1], group))


def merge_shards(words: np.ndarray, group: np.ndarray, shards: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): all suffixes in order, and common bytes of each with the one before it.

    The interleave of the shards begins as one block per group, every shard's suffixes in
    their own order in it, and is refined by one word after the other: inside a block a
    stable sort only merges runs that are sorted already. Where a block splits, the words
    that differ say how many bytes the neighbours share; ``common`` is -1 between groups.
    """
    order = np.concatenate(shards)
    order = order[np.argsort(group[order], kind="stable")]
    block = group[order]
    common = np.full(len(order), 8 * words.shape[1], np.int64)
    common[np.concatenate([[True], block[1:] != block[:-1]])] = -1
    block = np.cumsum(common < 0)
    open_ = np.arange(len(order))
    for w in range(words.shape[1]):
        # Only blocks of more than one are still open.
        sizes = np.bincount(block[open_], minlength=0)
        open_ = open_[sizes[block[open_]] > 1]
        if not len(open_):
            break
        word = words[order[open_], w]
        sort = np.lexsort((word, block[open_]))
        order[open_], word = order[open_][sort], word[sort]
        same_block = np.concatenate([[False], block[open_][1:] == block[open_][:-1]])
        split = same_block & np.concatenate([[False], word[1:] != word[:-1]])
        at = np.flatnonzero(split)
        differ = word[at] ^ word[at - 1]
        lead = 63 - np.floor(np.log2(differ.astype(np.float64))).astype(np.int64)
        # A float may round up to the next power of two.
        lead += (differ >> np.minimum(63 - lead, 63).astype(np.uint64) == 0).astype(np.int64)
        common[open_[at]] = 8 * w + lead // 8
        fresh = np.zeros(len(order), np.int64)
        fresh[open_[at]] = 1
        block = block + np.cumsum(fresh)
    return order, common


class _RangeMinimum:
    def __init__(self, values: np.ndarray):
        self.rows = [values.astype(np.int32)]
        while 2 ** len(self.rows) <= len(values):
            half, last = 2 ** (len(self.rows) - 1), self.rows[-1]
            self.rows.append(np.minimum(last[:-half], last[half:]))

    def __call__(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minimum over first..last, both included."""
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        found = np.empty(len(first), np.int32)
        for k in np.unique(level):
            at = level == k
            row = self.rows[k]
            found[at] = np.minimum(row[first[at]], row[last[at] - 2**k + 1])
        return found


def extend_left(before: np.ndarray, lefts: np.ndarray, rights: np.ndarray, order: np.ndarray, common: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(left, right) of every suffix: how far repeats of ``length`` reach on either side; -1 for none.

    ``before[i, d]`` is the byte d + 1 places before suffix i, of which it has ``lefts[i]``;
    ``rights`` are the suffixes' own lengths.
    """
    reach_left = np.full(len(order), -1, np.int64)
    reach_right = np.full(len(order), -1, np.int64)
    least = _RangeMinimum(common)
    rank = np.arange(len(order))  # places in the order, by interval and then by order
    interval = np.cumsum(common < 0)
    for d in range(before.shape[1] + 1):
        if d:
            rank_has = lefts[order[rank]] >= d
            rank, interval = rank[rank_has], interval[rank_has]
            symbol = before[order[rank], d - 1].astype(np.int64)
            key = interval * 256 + symbol
            sort = np.argsort(key, kind="stable")
            rank, key = rank[sort], key[sort]
            interval = np.cumsum(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else key
        together = interval[1:] == interval[:-1]
        alone = ~(np.concatenate([[False], together]) | np.concatenate([together, [False]])) if len(rank) else np.zeros(0, bool)
        if alone.any():
            rank, interval = rank[~alone], interval[~alone]
            together = interval[1:] == interval[:-1]
        if not len(rank):
            break
        pair = np.flatnonzero(together)
        shared = np.full(len(together), -1, np.int64)
        shared[pair] = least(rank[pair] + 1, rank[pair + 1])
        best = np.maximum(np.concatenate([[-1], shared]), np.concatenate([shared, [-1]]))
        own = order[rank]
        best = np.minimum(best, rights[own])
        hit = best >= length - d
        reach_left[own[hit]] = d
        reach_right[own[hit]] = np.maximum(reach_right[own[hit]], best[hit])
    return reach_left, reach_right


def _matched(table: pa.Table, shape: Shape) -> pa.RecordBatch:
    """(gram, context, left, right) of the contexts in a repeat, by merging shards of them."""
    gram, context = table["gram"].to_numpy(), table["context"].to_numpy()
    lefts, rights = table["left"].to_numpy(), table["right"].to_numpy()
    width = -(-shape.length // 8) * 8
    data = np.frombuffer(b"".join(table["bytes"].to_pylist()), np.uint8).reshape(len(gram), shape.left + width)
    before, words = data[:, : shape.left], np.ascontiguousarray(data[:, shape.left :]).view(">u8").astype(np.uint64)
    group = np.cumsum(np.concatenate([[True], gram[1:] != gram[:-1]])) - 1
    shards = []
    for start in range(0, len(gram), SHARD):
        part = slice(start, start + SHARD)
        shards.append(start + sort_shard(words[part], group[part]))
    order, common = merge_shards(words, group, shards)
    common = np.minimum(common, shape.length)
    left, right = extend_left(before, lefts, rights, order, common, shape.length)
    hit = left >= 0
    return pa.RecordBatch.from_arrays(
        [pa.array(gram[hit]), pa.array(context[hit]), pa.array(left[hit]), pa.array(right[hit])],
        names=["gram", "context", "left", "right"],
    )


def _merge_partitions(shape: Shape):
    """Whole grams are taken together until there are ``TOGETHER`` contexts."""

    def run(batches):
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not len(batch):
                continue
            if size >= TOGETHER:
                gram = batch.column("gram").to_numpy()
                last = held[-1].column("gram")[len(held[-1]) - 1].as_py()
                other = np.flatnonzero(gram != last)
                if len(other):
                    held.append(batch.slice(0, int(other[0])))
                    yield _matched(pa.Table.from_batches(held), shape)
                    batch, held, size = batch.slice(int(other[0])), [], 0
            held.append(batch)
            size += len(batch)
        if held:
            yield _matched(pa.Table.from_batches(held), shape)

    return run


def _windows(shape: Shape):
    """(gram, context, left, h1, h2): hashes of every window around an anchor that has ``left`` bytes before it."""

    def run(batches):
        one, two = Hashes(2), Hashes(3)
        for batch in batches:
            gram, context = batch.column("gram").to_numpy(), batch.column("context").to_numpy()
            lefts, rights = batch.column("left").to_numpy(), batch.column("right").to_numpy()
            for i, raw in enumerate(batch.column("bytes").to_pylist()):
                row = np.frombuffer(raw, np.uint8)
                text = np.concatenate([row[: lefts[i]][::-1], row[shape.left : shape.left + rights[i]]])
                begin = np.arange(len(text) - shape.length + 1)
                begin = begin[begin <= lefts[i]]
                digest = [h.between(h.prefixes(text), begin, begin + shape.length).view(np.int64) for h in (one, two)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(begin), gram[i])), pa.array(np.full(len(begin), context[i])), pa.array(lefts[i] - begin), *map(pa.array, digest)],
                    names=["gram", "context", "left", "h1", "h2"],
                )

    return run


def _contexts(rows: DataFrame, shape: Shape) -> DataFrame:
    """(gram, context, left, right, bytes): what stands around each place of ``rows`` (text, places)."""
    width = -(-shape.length // 8) * 8

    def run(batches):
        for batch in (part for batch in batches for part in sliced(batch, 0)):
            out = []
            for text, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for place in places:
                    at = place["position"]
                    left, right = text[max(0, at - shape.left) : at][::-1], text[at : at + shape.length]
                    raw = left.ljust(shape.left, b"\xff") + right.ljust(width, b"\xff")
                    out.append((place["gram"], place["context"], len(left), len(right), raw))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["gram", "context", "left", "right", "bytes"]
            )

    schema = "gram bigint, context bigint, left bigint, right bigint, bytes binary"
    return rows.select("text", "places").mapInArrow(run, schema)


def repeated_spans(keyed: DataFrame, shape: Shape = Shape(), most_together: int = MOST_TOGETHER) -> DataFrame:
    """(k1, k2, spans) of every text that holds a repeat; spans may overlap and pass the text's ends.

    ``keyed`` has k1, k2 - together the identity of a text - and text. Rows of equal texts
    count as occurrences of their own.
    """
    spark, every = keyed.sparkSession, scratch_dir(keyed.sparkSession)
    anchors = settle(_anchor_rows(keyed, shape), every)
    again = anchors.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram")
    # Both follow the corpus: joined by shuffle at every size.
    anchors = settle(anchors.join(settle(again).hint("merge"), "gram", "left_semi"))
    files.remove(spark, every)  # most grams occur once: the bulk of it is not needed any more

    place = F.struct("k1", "k2", "position")
    kinds = settle(anchors.groupBy("gram", "context").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("p")))
    # A context found twice is repeat as far as it goes.
    limits = {"left": F.lit(shape.left).cast("long"), "right": F.lit(shape.length).cast("long")}
    twice = kinds.where("n > 1").select("gram", "context", *[v.alias(k) for k, v in limits.items()])
    several = settle(kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1"))

    wanted = kinds.join(several, "gram").select(
        "p.k1", "p.k2", F.struct("p.position", "gram", "context").alias("place"), "kinds"
    )
    # A text's places: no more than it has bytes.
    wanted = settle(wanted.groupBy("k1", "k2").agg(F.collect_list("place").alias("places")))
    texts = keyed.select("k1", "k2", F.col("text").cast("binary").alias("text")).dropDuplicates(["k1", "k2"])
    contexts = settle(_contexts(texts.join(wanted, ["k1", "k2"]), shape))
    hot = several.where(f"kinds > {most_together}").select("gram")
    crowded = contexts.join(hot, "gram", "left_semi")
    parts = max(1, math.ceil(contexts.count() / TOGETHER))
    schema = "gram bigint, context bigint, left bigint, right bigint"
    merged = (
        contexts.join(hot, "gram", "left_anti")
        .repartition(parts, "gram")
        .sortWithinPartitions("gram", "context")
        .mapInArrow(_merge_partitions(shape), schema)
    )
    windows = crowded.mapInArrow(_windows(shape), "gram bigint, context bigint, left bigint, h1 bigint, h2 bigint")
    # Equal windows have their anchor at the same distance; a place has one window for each.
    same = ["gram", "left", "h1", "h2"]
    held = windows.groupBy(*same).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*same)
    counted = windows.join(held, same, "left_semi").groupBy("gram", "context").agg(
        F.max("left").alias("left"), (F.lit(shape.length) - F.min("left")).alias("right")
    )
    reach = twice.unionByName(settle(merged))
    if not hot.isEmpty():
        reach = reach.unionByName(settle(counted))
    reach = settle(reach.groupBy("gram", "context").agg(F.max("left").alias("left"), F.max("right").alias("right")))
    span = F.struct((F.col("position") - F.col("left")).alias("begin"), (F.col("position") + F.col("right")).alias("end"))
    spans = anchors.join(reach, ["gram", "context"]).select("k1", "k2", span.alias("span")).distinct()
    return spans.groupBy("k1", "k2").agg(F.collect_list("span").alias("spans"))


# Removal

RESULT = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


def union_of(spans: list[tuple[int, int]], size: int) -> list[tuple[int, int]]:
    """Maximal runs inside 0..size that the spans cover."""
    runs: list[tuple[int, int]] = []
    for begin, end in sorted((max(0, b), min(size, e)) for b, e in spans):
        if runs and begin <= runs[-1][1]:
            runs[-1] = runs[-1][0], max(end, runs[-1][1])
        else:
            runs.append((begin, end))
    return runs


def is_passage(run: bytes, words: int) -> bool:
    """Whether a run is long: in bytes, or in words."""
    return not words or len(run) >= LENGTH or len(WORDS.findall(run)) >= words


def _removed(rows: DataFrame, with_text: bool, words: int = 0) -> DataFrame:
    """(k1, k2, n_removed, n_spans, kept_sha256[, kept_text]) from (k1, k2, text, spans)."""

    def run(batches):
        for batch in (part for batch in batches for part in sliced(batch, 2)):
            out = []
            for k1, k2, text, spans in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                runs = union_of([(s["begin"], s["end"]) for s in spans], len(text))
                runs = [(a, b) for a, b in runs if is_passage(text[a:b], words)]
                bounds = [0, *(x for r in runs for x in r), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True))
                row = (k1, k2, len(text) - len(kept), len(runs), hashlib.sha256(kept).hexdigest())
                out.append((*row, kept.decode("utf-8", "ignore")) if with_text else row)
            columns = list(zip(*out, strict=True)) or [()] * (5 + with_text)
            kinds = [pa.int64()] * 4 + [pa.string()] * (1 + with_text)
            names = ["k1", "k2", "n_removed", "n_spans", "kept_sha256"] + ["kept_text"] * with_text
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    schema = "k1 bigint, k2 bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return rows.select("k1", "k2", "text", "spans").mapInArrow(run, schema + ", kept_text string" * with_text)


def keyed_texts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the identity of every text in _k1 and _k2."""
    text = whole(quoted(text_col))
    return docs.withColumns({"_k1": F.xxhash64(text), "_k2": F.xxhash64(F.lit(1), text)})


def remove_repeats(docs: DataFrame, text_col: str = "text", shape: Shape = Shape(), replace_text: bool = False, most_together: int = MOST_TOGETHER, words: int = 0) -> DataFrame:
    """Every row with the columns of ``RESULT``; with ``replace_text`` also the text that is left.

    Matches never cross rows. NULL text is the empty text, texts shorter than ``shape.length``
    lose nothing, repeated rows are occurrences of each other. A character that loses some of
    its bytes loses all in the replaced text; the digest is of the bytes. Without
    ``replace_text`` the text column is dropped. Input columns named like a result are
    replaced, those named like a working column come back as they are. No rows give no rows.
    With ``words`` a removed run of fewer words and fewer than ``LENGTH`` bytes stays.
    """
    docs, back = shielded(docs, "_k1", "_k2", "k1", "k2", "_whole_sha256", "_whole_text", "kept_text")
    text = whole(quoted(text_col))
    keyed = keyed_texts(docs, text_col)
    slim = keyed.select(F.col("_k1").alias("k1"), F.col("_k2").alias("k2"), text.alias("text"))
    spans = settle(repeated_spans(slim, shape, most_together))
    texts = slim.withColumn("text", F.col("text").cast("binary")).dropDuplicates(["k1", "k2"])
    removed = settle(_removed(texts.join(spans, ["k1", "k2"]), replace_text, words))
    own = [c for c in without(docs, *RESULT) if c != text_col]
    rows = keyed.select(
        *[quoted(c) for c in own], F.col("_k1").alias("k1"), F.col("_k2").alias("k2"),
        F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("_whole_sha256"),
        *([text.alias("_whole_text")] if replace_text else []),
    )
    left = [F.coalesce("kept_text", "_whole_text").alias(text_col)] if replace_text else []
    return rows.join(removed, ["k1", "k2"], "left").select(
        *[quoted(c) for c in own],
        *left,
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "_whole_sha256").alias("kept_sha256"),
    ).withColumnsRenamed(back)
