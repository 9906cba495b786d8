"""N-gram Jaccard join by chosen paths.

A document is the set of its word 5-grams; documents of one set are one class from the start
and only one of each class is joined. In every run a set chooses a few of its own shingles by a random function all
sets share, so that sets that share most shingles are likely to choose a common one: the
chosen shingles are buckets. A bucket that is still large splits again on shingles chosen at
the next level, down to ``LEVELS``. Small buckets are compared by brute force on sketches:
some thousand members take a core seconds, splitting them takes several jobs.

With ``CHANCES`` expected common choices a level, a pair at the threshold meets in a run with
probability (1 - exp(-CHANCES)) ** LEVELS at least; runs repeat until the wanted recall of
such pairs is reached (``runs_for``). More similar pairs meet more often.

Sketch comparison keeps a wide margin and yields candidate groups only. In each group the
whole sets are then compared exactly, in blocks of bounded size, which counts every document's
links and gives the links that the classes are connected by.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import WORD, quoted, shielded, whole, without
from orderloom.llm.components import components
from orderloom.session import settle

WORDS = re.compile(WORD)
SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9999
LEVELS = 3
CHANCES = 3.0
SMALL_BUCKET = 16_384
#: Rows of a block in pairwise comparison of whole sets, and of sketches.
BLOCK, SKETCH_BLOCK = 256, 4_096
BINS = 128
#: Sketches differ from the truth by 0.036 (standard deviation) at the threshold.
SKETCH_MARGIN = 0.16
CACHE_WORDS = 500_000
RESULT = ("class_id", "n_links", "class_size")


def runs_for(recall: float, levels: int = LEVELS, chances: float = CHANCES) -> int:
    """Runs after which a pair at the threshold has met with probability ``recall``."""
    miss = 1 - (1 - math.exp(-chances)) ** levels
    return math.ceil(math.log(1 - recall) / math.log(miss))


# Sets


def _mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct shingle hashes of texts; word hashes are remembered."""

    def __init__(self, size: int = SHINGLE):
        self.size, self.cache = size, {}

    def _word(self, word: str) -> int:
        value = self.cache.get(word)
        if value is None:
            if len(self.cache) > CACHE_WORDS:
                self.cache.clear()
            value = self.cache[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value

    def __call__(self, text: str) -> np.ndarray:
        words = np.array(list(map(self._word, WORDS.findall(text))), np.uint64)
        size = min(self.size, len(words))
        if not size:
            return words
        found = np.zeros(len(words) - size + 1, np.uint64)
        for i in range(size):
            found = _mix(found + words[i : len(words) - size + 1 + i] + np.uint64(size))
        return np.unique(found)


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values, pa.int64()))


def _sketches(hashes: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
    """One-permutation minima: per bin 16 bits of the smallest hash, 0 for none."""
    mixed = _mix(hashes ^ np.uint64(0x5BD1E995))
    slot = owner * BINS + (mixed & np.uint64(BINS - 1)).astype(np.int64)
    smallest = np.full(rows * BINS, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(smallest, slot, mixed >> np.uint64(8))
    return np.where(smallest == np.iinfo(np.uint64).max, 0, 1 + _mix(smallest) % np.uint64(65535)).astype(np.uint16).reshape(rows, BINS)


def describe(docs: DataFrame, runs: int, levels: int, chances: float, threshold: float) -> DataFrame:
    """(id, key, set_id, n, sketch, choices) of every row; see ``join`` for the columns of ``docs``.

    ``key`` is a digest of the text, ``set_id`` one of its shingle set, ``choices`` holds what
    the set chooses in each run and level, at place run * levels + level.
    """

    def run(batches):
        shingles = Shingler()
        for whole_batch in batches:
            for at in range(0, len(whole_batch), 500):
                batch = whole_batch.slice(at, 500)
                sets = [shingles(t) for t in batch.column(2).to_pylist()]
                sizes = np.fromiter(map(len, sets), np.int64, len(sets))
                owner = np.repeat(np.arange(len(sets)), sizes)
                hashes = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                # 21 bits a level: far finer than the share of shingles that is chosen.
                limit = np.minimum(chances / (threshold * np.maximum(sizes, 1)), 1.0) * (1 << 21)
                limit = np.ceil(limit).astype(np.uint64)[owner]
                picked, counts = [], np.zeros((len(sets), runs * levels), np.int64)
                for r in range(runs):
                    mixed = _mix(hashes + np.uint64(0x9E3779B97F4A7C15 * (r + 1) % (1 << 64)))
                    for level in range(levels):
                        bits = mixed >> np.uint64(21 * level) & np.uint64((1 << 21) - 1)
                        chosen = np.flatnonzero(bits < limit)
                        picked.append(chosen)
                        counts[:, r * levels + level] = np.bincount(owner[chosen], minlength=len(sets))
                # Row by row, and in a row by run and level.
                flat = np.concatenate(picked) if picked else np.zeros(0, np.int64)
                place = np.repeat(np.arange(runs * levels), [len(p) for p in picked])
                flat = flat[np.lexsort((place, owner[flat]))]
                inner = _lists(hashes[flat].view(np.int64), counts.ravel())
                outer = pa.array(np.arange(len(sets) + 1) * runs * levels, pa.int32())
                digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(1),
                        pa.array(digests, pa.binary()),
                        pa.array(sizes),
                        pa.array([s.tobytes() for s in _sketches(hashes, owner, len(sets))], pa.binary()),
                        pa.ListArray.from_arrays(outer, inner),
                    ],
                    names=["id", "key", "set_id", "n", "sketch", "choices"],
                )

    kind = docs.schema["id"].dataType.simpleString()
    schema = f"id {kind}, key binary, set_id binary, n bigint, sketch binary, choices array<array<bigint>>"
    return docs.select("id", "key", "text").mapInArrow(run, schema)


# Grouped comparison


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Consecutive rows that agree in the first ``keys`` columns, over batch borders."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        values = list(zip(*[batch.column(i).to_pylist() for i in range(keys)], strict=True))
        start = 0
        for i, value in enumerate(values):
            if value != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, last = [], i, value
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def _blocks(rows: DataFrame, group: str, size: Column, member: str, block: int) -> DataFrame:
    """Deal a group's members into blocks and every block to all pairs of blocks it is in.

    Adds lo, hi (the pair) and own (the member's block). A group within ``block`` is one pair.
    """
    blocks = F.ceil(size / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64(member), blocks).cast("int")
    others = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda other: F.struct(F.least(own, other).alias("lo"), F.greatest(own, other).alias("hi")),
    )
    dealt = rows.withColumn("_pair", F.explode(others)).withColumn("own", own)
    return dealt.withColumn("lo", F.col("_pair.lo")).withColumn("hi", F.col("_pair.hi")).drop("_pair")


def _sorted_by(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.repartition(*keys).sortWithinPartitions(*keys)


class _Forest:
    def __init__(self, n: int):
        self.above = list(range(n))

    def root(self, i: int) -> int:
        while self.above[i] != i:
            self.above[i] = self.above[self.above[i]]
            i = self.above[i]
        return i

    def link(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        self.above[max(a, b)] = min(a, b)
        return a != b


def _link_batch(links: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    a, b = zip(*links, strict=True) if links else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def _candidates(threshold: float, margin: float):
    """Links that connect the members of each bucket whose sketches look similar enough."""

    def run(batches):
        links: list[tuple[bytes, bytes]] = []
        for table in _groups(batches, 3):
            ids, sizes = table["set_id"].to_pylist(), table["n"].to_numpy()
            own, across = table["own"].to_numpy(), table["lo"][0].as_py() != table["hi"][0].as_py()
            sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint16).reshape(len(ids), BINS)
            order = np.argsort(sizes, kind="stable")
            sizes, own, sketch = sizes[order], own[order], sketch[order]
            # By size, the partners of a set are the next ones up to the size it can be similar to.
            until = np.searchsorted(sizes, sizes / threshold + 1e-9, side="right")
            forest = _Forest(len(ids))
            for i in range(len(ids) - 1):
                later = sketch[i + 1 : until[i]]
                if not len(later):
                    continue
                filled = ((later | sketch[i]) > 0).sum(1)
                same = ((later == sketch[i]) & (later > 0)).sum(1)
                near = same >= (threshold - margin) * filled
                if across:
                    near &= own[i + 1 : until[i]] != own[i]
                for j in (np.flatnonzero(near) + i + 1).tolist():
                    if forest.link(i, j):
                        links.append((ids[order[i]], ids[order[j]]))
            if len(links) > 20_000:
                yield _link_batch(links)
                links = []
        yield _link_batch(links)

    return run


def _shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Common elements of every left with every right set."""
    if len(left) * len(right) <= 16:
        return np.array([[len(np.intersect1d(a, b, assume_unique=True)) for b in right] for a in left])
    counts = np.zeros((len(left), len(right)), np.float32)
    tokens, column = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    sizes = [len(s) for s in (*left, *right)]
    row = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = 8192
    for start in range(0, len(tokens), width):
        a, b = np.searchsorted(column, (start, start + width))
        held = np.zeros((len(sizes), width), np.float32)
        held[row[a:b], column[a:b] - start] = 1
        counts += held[: len(left)] @ held[len(left) :].T
    return counts.astype(np.int64)


def _exact(threshold_tenths: int):
    """Per member and block pair: linked documents, and links that connect the block pair."""

    def run(batches):
        for table in _groups(batches, 3):
            ids, weights = table["set_id"].to_pylist(), table["documents"].to_numpy()
            sets = [np.frombuffer(s, np.uint64) for s in table["shingles"].to_pylist()]
            sizes = np.array([len(s) for s in sets])
            lo, hi = table["lo"][0].as_py(), table["hi"][0].as_py()
            own = table["own"].to_numpy()
            rows = np.flatnonzero(own == lo)
            columns = rows if lo == hi else np.flatnonzero(own == hi)
            if not len(rows) or not len(columns):
                continue
            shared = _shared_counts([sets[i] for i in rows], [sets[j] for j in columns])
            union = sizes[rows][:, None] + sizes[columns][None] - shared
            linked = (10 * shared >= threshold_tenths * union) & (rows[:, None] != columns[None])
            counts = np.zeros(len(ids), np.int64)
            counts[rows] += (linked * weights[columns][None]).sum(1)
            if lo != hi:
                counts[columns] += (linked * weights[rows][:, None]).sum(0)
            forest = _Forest(len(ids))
            first = [None] * len(ids)
            for i, j in zip(*np.nonzero(linked), strict=True):
                i, j = int(rows[i]), int(columns[j])
                if forest.link(i, j):
                    first[max(i, j)] = first[max(i, j)] or []
                    first[max(i, j)].append(ids[min(i, j)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.binary()), pa.array(counts), pa.array([f or [] for f in first], pa.list_(pa.binary()))],
                names=["set_id", "links", "linked_to"],
            )

    return run


def _with_shingles(rows: DataFrame) -> DataFrame:
    """(set_id, group, documents, group_size, text) with the text's shingle set instead of the text."""

    def run(batches):
        shingles = Shingler()
        for batch in batches:
            sets = [shingles(t).tobytes() for t in batch.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(sets, pa.binary())], names=[*batch.schema.names[:4], "shingles"]
            )

    schema = "set_id binary, group binary, documents bigint, group_size bigint, shingles binary"
    return rows.select("set_id", "group", "documents", "group_size", "text").mapInArrow(run, schema)


# The join


def _near_pivots(large: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) of the members of large buckets to their bucket's first, by sketches, a row at a time."""

    def run(batches):
        for batch in batches:
            sketches = [np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, BINS) for i in (2, 3)]
            filled = ((sketches[0] | sketches[1]) > 0).sum(1)
            same = ((sketches[0] == sketches[1]) & (sketches[0] > 0)).sum(1)
            near = pa.array(same >= (THRESHOLD - SKETCH_MARGIN) * filled)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(near), batch.column(1).filter(near)], names=["a", "b"])

    firsts = large.groupBy("run", "bucket").agg(F.min("set_id").alias("b"))
    pairs = large.join(firsts, ["run", "bucket"]).where("set_id <> b").select(F.col("set_id").alias("a"), "b").distinct()
    mine = sets.select(F.col("set_id").alias("a"), F.col("sketch").alias("sketch_a"))
    first = sets.select(F.col("set_id").alias("b"), F.col("sketch").alias("sketch_b"))
    both = pairs.join(mine, "a").join(first, "b").select("a", "b", "sketch_a", "sketch_b")
    return settle(both.mapInArrow(run, "a binary, b binary"))


def _buckets(sets: DataFrame, runs: int, levels: int, small: int) -> tuple[DataFrame, DataFrame | None]:
    """(buckets, links): (bucket, size, set_id) of what is left to compare, and links found on the way.

    A bucket is ready when it is small or at the last level. Members of a large one are first
    held against its first member; buckets whose members are then all connected have nothing
    left to find, and neither has a second bucket of the same members that is compared now. Those
    that still split do so in every run: runs are independent tries at the next level, too.
    """
    first = f"flatten(transform(sequence(0, {runs - 1}), r -> transform(choices[r * {levels}], t -> named_struct('run', r, 'bucket', xxhash64(r, t)))))"
    paths = sets.select("set_id", F.explode(F.expr(first)).alias("p")).select("set_id", "p.run", "p.bucket")
    done: DataFrame | None = None
    links: DataFrame | None = None
    for level in range(levels):
        paths = settle(paths)
        held = paths.groupBy("run", "bucket").agg(
            F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("set_id")).alias("members")
        )
        last = level == levels - 1
        splits = F.lit(False) if last else F.col("size") > small
        alike = [F.when(splits, F.col("run")).alias("of_run"), "size", "members"]
        once = held.where("size > 1").groupBy(*alike).agg(F.min(F.struct("run", "bucket")).alias("b"))
        once = settle(once.select("size", "b.run", "b.bucket"))
        found = settle(paths.join(once.hint("merge"), ["run", "bucket"]).select("run", "bucket", "size", "set_id"))
        large = found.where(f"size > {small}")
        if not large.isEmpty():
            near = _near_pivots(large, sets)
            links = near if links is None else links.unionByName(near)
            labels = components(links).withColumnRenamed("id", "set_id")
            label = F.coalesce("label", "set_id")
            mixed = found.join(labels, "set_id", "left").groupBy("run", "bucket").agg(F.min(label).alias("a"), F.max(label).alias("b"))
            mixed = settle(mixed.where("a <> b").select("run", "bucket"))
            found = settle(found.join(mixed, ["run", "bucket"], "left_semi"))
            large = found.where(f"size > {small}")
        ready = found.select("bucket", "size", "set_id").where("true" if last else f"size <= {small}")
        done = ready if done is None else done.unionByName(ready)
        if last or large.isEmpty():
            break
        deeper = f"transform(choices[run * {levels} + {level + 1}], t -> xxhash64(bucket, t))"
        paths = large.join(sets.select("set_id", "choices"), "set_id").select("set_id", "run", F.explode(F.expr(deeper)).alias("bucket"))
    return done, links


def classes(docs: DataFrame, recall: float = RECALL, small: int = SMALL_BUCKET, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(rows, linked): every row's set, and class and links of the sets that have a link.

    ``docs`` has id and text. ``rows`` is (id, key, set_id, n); ``linked`` is (set_id, label, links).
    """
    runs = runs_for(recall)
    keyed = docs.select("id", whole("text").alias("text")).withColumn("key", F.unhex(F.md5("text")))
    described = settle(describe(keyed, runs, LEVELS, CHANCES, THRESHOLD))
    rows = described.select("id", "key", "set_id", "n")
    # All columns but the key depend on the set alone.
    alike = {c: F.first(c).alias(c) for c in ("n", "sketch", "choices")}
    sets = described.where("set_id is not null").groupBy("set_id").agg(
        *alike.values(), F.min("key").alias("key"), F.count(F.lit(1)).alias("documents")
    )
    sets = settle(sets)

    buckets, found = _buckets(sets, runs, LEVELS, small)
    members = buckets.join(sets.select("set_id", "n", "sketch"), "set_id")
    members = _blocks(members, "bucket", F.col("size"), "set_id", min(SKETCH_BLOCK, 16 * block))
    members = _sorted_by(members.select("bucket", "lo", "hi", "own", "set_id", "n", "sketch"), ["bucket", "lo", "hi"])
    links = members.mapInArrow(_candidates(THRESHOLD, SKETCH_MARGIN), "a binary, b binary")
    near = components(links if found is None else links.unionByName(found)).withColumnRenamed("label", "group")

    sizes = near.groupBy("group").agg(F.count(F.lit(1)).alias("group_size"))
    wanted = near.withColumnRenamed("id", "set_id").join(sizes, "group").join(sets.select("set_id", "key", "documents"), "set_id")
    # Their number follows the corpus: joined by shuffle at every size.
    texts = keyed.select("key", "text").join(settle(wanted).hint("merge"), "key").dropDuplicates(["key"])
    compared = settle(_with_shingles(texts))
    compared = _blocks(compared, "group", F.col("group_size"), "set_id", block)
    compared = _sorted_by(
        compared.select("group", "lo", "hi", "own", "set_id", "documents", "shingles"), ["group", "lo", "hi"]
    )
    schema = "set_id binary, links bigint, linked_to array<binary>"
    exact = settle(compared.mapInArrow(_exact(round(10 * THRESHOLD)), schema))
    links = exact.select(F.col("set_id").alias("a"), F.explode("linked_to").alias("b"))
    labels = components(links).withColumnRenamed("id", "set_id")
    counts = exact.groupBy("set_id").agg(F.sum("links").alias("links"))
    return rows, settle(labels.join(counts, "set_id"))


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", recall: float = RECALL, small: int = SMALL_BUCKET, block: int = BLOCK) -> DataFrame:
    """(id_col, class_id, class_size, n_links), a row for every input row.

    ``class_id`` is the smallest id of the documents connected by links, ``class_size`` counts
    them, ``n_links`` counts the other documents whose shingle set has a Jaccard similarity of
    ``THRESHOLD`` or more with the row's. A text of fewer than five words has one shingle, all
    its words. A text without words (NULL too) links to nothing and is a class of its own; if
    its id is NULL its class id is, too. NULL ids of other rows rank above all others. Repeated
    rows are documents of the same set. No rows give no rows.
    """
    rows, linked = classes(docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text")), recall, small, block)
    joined = rows.where("set_id is not null").select("id", "set_id").join(linked, "set_id", "left")
    joined = joined.select("id", "set_id", F.coalesce("label", "set_id").alias("label"), F.coalesce("links", F.lit(0)).alias("links"))
    joined = settle(joined)
    of_class = joined.groupBy("label").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    of_set = joined.groupBy("set_id").agg(F.count(F.lit(1)).alias("alike"))
    with_class = joined.join(settle(of_class), "label").join(settle(of_set), "set_id").select(
        F.col("id").alias(id_col), "class_id", "class_size", (F.col("links") + F.col("alike") - 1).alias("n_links")
    )
    alone = rows.where("set_id is null").select(
        F.col("id").alias(id_col), F.col("id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(0).cast("long").alias("n_links")
    )
    return with_class.unionByName(alone)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of every class, the one of the smallest id; rows without words all stay.

    Of rows that repeat the smallest id one stays. Columns come back as they are, those named
    like a working column too. No rows give no rows.
    """
    docs, back = shielded(docs, "_own_key", "_id", "_key")
    rows, linked = classes(docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text")))
    alike = rows.where("set_id is not null").groupBy("set_id", "id", "key").agg(F.count(F.lit(1)).alias("copies"))
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "key", "copies")).alias("first")
    stays = alike.join(linked, "set_id", "left").groupBy(F.coalesce("label", "set_id").alias("label")).agg(first)
    stays = settle(stays.select(*[F.col(f"first.{c}").alias(f"_{c}") for c in ("id", "key", "copies")]))
    text = whole(quoted(text_col))
    keyed = docs.withColumn("_own_key", F.unhex(F.md5(text)))
    match = F.col("_own_key").eqNullSafe(F.col("_key")) & quoted(id_col).eqNullSafe(F.col("_id"))
    kept = keyed.join(stays.drop("_copies"), match, "left_semi")
    # Whole rows move once more, or are read once more, only where there is something to find.
    if not stays.where("_copies > 1").isEmpty():
        kept = kept.dropDuplicates([id_col, "_own_key"])
    kept = kept.drop("_own_key")
    if not rows.where("set_id is null").isEmpty():
        kept = kept.unionByName(docs.where(~text.rlike(WORD)))
    return kept.withColumnsRenamed(back)
