"""Conversation prefix trie by vertical bitmaps.

A node of depth d is a distinct sequence of the first d turns; the conversations that start
with it are its members. Conversations are cut into shards by runs of their ids. A shard
indexes (position, turn) to the bitset of its conversations that have this turn there, and
the conversations that end at a length. From the root down, depth first, a node's bitset is
intersected with the postings of the next position: each result that is not empty is a child,
its popcount the members, its part of the shard's end bitset the conversations that end there.
Only postings that some member points to are met, so a shard does as many intersections as it
has nodes.

Shards know nothing of each other: a node's rows from all shards are summed by the digest of
its path. So a prefix that a third of all conversations share is one row of every shard, and
no task holds its members. Sums over subtrees double their reach from round to round (of the
nodes that two conversations share; below a node of one member there is a single leaf).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import WORD, quoted, whole
from orderloom.session import settle

#: Conversation ids a shard spans: the width of its bitsets.
SHARD_IDS = 1_000
#: Node rows a task hands over at a time.
BATCH_ROWS = 20_000
MOST_ROUNDS = 60
ROOT = b"\x00" * 16

NODES = "path binary, parent binary, depth long, words long, conv_id long, n_convs long, shard long, ends string"


def turn_digest(role: Column, text: Column) -> Column:
    """128 bits, as hex, that tell a turn's role and text."""
    return F.md5(F.concat_ws(":", F.octet_length(role).cast("string"), role, text))


def turns_of(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv_id, place, turn, words): every turn by its digest, with its place from 1 and its words.

    Ordered by turn, NULL first; turns of one number by role, then by digest. NULL roles and
    texts are empty. Rows without a conversation id belong to no conversation. Turns cross the
    shuffle as digests; of a conversation of any length no more than a sort is held.
    """
    role, text = whole(quoted(role_col)), whole(quoted(text_col))
    rows = conversations.where(quoted(id_col).isNotNull()).select(
        quoted(id_col).cast("long").alias("conv_id"),
        quoted(turn_col).alias("number"),
        role.alias("role"),
        turn_digest(role, text).alias("turn"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("number").asc_nulls_first(), "role", "turn")
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("place"), "turn", "words")


def with_shared_heads(turns: DataFrame, family: int = 20, most: int = 3) -> DataFrame:
    """Conversations rebuilt: the first h turns of conversation c - c % family, then c's own after its first h.

    h is the crc32 of c in decimal modulo ``most`` + 1. A conversation that is left with no turn
    stays, as one row of NULL turn.
    """
    conv = F.col("conv_id")
    h = F.pmod(F.crc32(conv.cast("string")), F.lit(most + 1))
    own = turns.where(F.col("place") > h)
    heads = turns.where((F.col("place") <= most) & (conv % family == 0)).select(
        conv.alias("donor"), F.col("place").alias("head_place"), F.col("turn").alias("head"), F.col("words").alias("head_words")
    )
    members = turns.where("place = 1").select(conv, h.alias("h"), (conv - conv % family).alias("donor"))
    lent = members.join(heads, "donor", "left").where(F.col("head_place").isNull() | (F.col("head_place") <= F.greatest(F.lit(1), "h")))
    # One row of every conversation comes through whatever h is: without a turn of the donor it is blank.
    use = F.col("head_place") <= F.col("h")
    lent = lent.select(
        "conv_id",
        F.lit(0).alias("part"),
        F.coalesce("head_place", F.lit(0)).alias("place"),
        F.when(use, F.col("head")).alias("turn"),
        F.when(use, F.col("head_words")).alias("words"),
    )
    return lent.unionByName(own.select("conv_id", F.lit(1).alias("part"), "place", "turn", "words"))


class Shard:
    """Bitmaps of a run of conversations: bit b is the conversation ``ids[b]``, ids ascending."""

    def __init__(self, conversations: list[tuple[int, list[str], list[int]]]):
        self.ids = [c for c, _, _ in conversations]
        self.turns = [t for _, t, _ in conversations]
        self.words = [w for _, _, w in conversations]
        self.postings: dict[tuple[int, str], int] = {}
        self.ended: dict[int, int] = {}
        for b, turns in enumerate(self.turns):
            bit = 1 << b
            for at, turn in enumerate(turns):
                self.postings[at, turn] = self.postings.get((at, turn), 0) | bit
            self.ended[len(turns)] = self.ended.get(len(turns), 0) | bit

    def members(self, bits: int) -> list[int]:
        found = []
        while bits:
            low = bits & -bits
            found.append(self.ids[low.bit_length() - 1])
            bits ^= low
        return found

    def nodes(self) -> Iterator[tuple]:
        """(path, parent path, depth, words of the last turn, smallest member, members, ends) of every node."""
        everyone = (1 << len(self.ids)) - 1
        stack = [(ROOT, None, 0, 0, everyone)]
        while stack:
            path, parent, depth, words, bits = stack.pop()
            ends = bits & self.ended.get(depth, 0)
            first = (bits & -bits).bit_length() - 1
            yield path, parent, depth, words, self.ids[first], bits.bit_count(), ",".join(map(str, self.members(ends)))
            left = bits ^ ends
            while left:
                b = (left & -left).bit_length() - 1
                turn = self.turns[b][depth]
                child = bits & self.postings[depth, turn]
                left &= ~child
                down = hashlib.blake2b(path + turn.encode(), digest_size=16).digest()
                stack.append((down, path, depth + 1, self.words[b][depth], child))


def _shard_nodes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Node rows of the shards of a partition, whose rows come in order of shard and conversation."""
    names = [c.split()[0] for c in NODES.split(", ")]
    types = [pa.binary(), pa.binary(), *[pa.int64()] * 5, pa.string()]
    out: list[tuple] = []

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    def rows_of(shard: int, held: list) -> Iterator[tuple]:
        for path, parent, depth, words, conv, n, ends in Shard(held).nodes():
            yield path, parent, depth, words, conv, n, shard, ends or None

    at, held = None, []
    for batch in batches:
        for shard, conv, turn, words in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if shard != at:
                if held:
                    out += rows_of(at, held)
                at, held = shard, []
            if not held or held[-1][0] != conv:
                held.append((conv, [], []))
            if turn is not None:
                held[-1][1].append(turn)
                held[-1][2].append(words)
            if len(out) >= BATCH_ROWS:
                yield packed(out)
                out = []
    if held:
        out += rows_of(at, held)
    if out:
        yield packed(out)


def _end_digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each path's lists of ends, which come in order of path and shard: only a running digest is held."""

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        paths, digests = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(paths, pa.binary()), pa.array(digests)], names=["path", "ends_sha256"])

    at, digest, out = None, None, []
    for batch in batches:
        for path, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if path == at:
                digest.update(b"," + ends.encode())
                continue
            if at is not None:
                out.append((at, digest.hexdigest()))
            at, digest = path, hashlib.sha256(ends.encode())
            if len(out) >= BATCH_ROWS:
                yield packed(out)
                out = []
    if at is not None:
        out.append((at, digest.hexdigest()))
    if out:
        yield packed(out)


def shard_nodes(rebuilt: DataFrame, shard_ids: int = SHARD_IDS) -> DataFrame:
    """The trie of every shard, a row of ``NODES`` per node: its members, and the ids that end there as text. Settled.

    ``rebuilt`` has (conv_id, part, place, turn, words); a row of NULL turn says that the
    conversation exists. A task holds one shard at a time.
    """
    shard = F.floor(F.col("conv_id") / F.lit(shard_ids)).cast("long").alias("shard")
    rows = rebuilt.select(shard, "conv_id", "turn", "words", "part", "place")
    dealt = rows.repartition("shard").sortWithinPartitions("shard", "conv_id", "part", "place")
    return settle(dealt.select("shard", "conv_id", "turn", "words").mapInArrow(_shard_nodes, NODES))


def _subtree_sums(shared: DataFrame) -> DataFrame:
    """(path, saved, leaves) with both summed over the subtree; rows come with their own and ``parent``.

    In round k a node knows the sums of its descendants less than 2^k below it and its ancestor
    2^k above it, and adds its sums to that ancestor's: as many rounds as the depth has bits.
    """
    known = settle(shared.select("path", F.col("parent").alias("above"), "saved", "leaves"))
    for _ in range(MOST_ROUNDS):
        climbing = known.where("above is not null")
        if climbing.isEmpty():
            return known
        heard = climbing.groupBy(F.col("above").alias("path")).agg(F.sum("saved").alias("more"), F.sum("leaves").alias("more_leaves"))
        up = known.select(F.col("path").alias("above"), F.col("above").alias("higher"))
        known = settle(
            known.join(heard, "path", "left")
            .join(up, "above", "left")
            .select(
                "path",
                F.col("higher").alias("above"),
                (F.col("saved") + F.coalesce("more", F.lit(0))).alias("saved"),
                (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            )
        )
    raise RuntimeError(f"the trie is deeper than 2^{MOST_ROUNDS}")


def trie(rebuilt: DataFrame, shard_ids: int = SHARD_IDS) -> DataFrame:
    """One row per node: path, parent, conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    ``rebuilt`` as in ``shard_nodes``. n_leaves and saved_tokens are over the subtree;
    saved_tokens are the words of a node's last turn for every member but one. ends_sha256 is
    of the decimal ids, ascending and comma-joined, of the conversations that end at the node.
    No conversations make no trie, not even a root.
    """
    parts = shard_nodes(rebuilt, shard_ids)
    nodes = settle(
        parts.groupBy("path").agg(
            F.first("parent").alias("parent"),
            F.first("depth").alias("depth"),
            F.first("words").alias("words"),
            F.min("conv_id").alias("conv_id"),
            F.sum("n_convs").alias("n_convs"),
        )
    )
    listed = parts.where("ends is not null").select("path", "shard", "ends")
    ordered = listed.repartition("path").sortWithinPartitions("path", "shard").select("path", "ends")
    ends = ordered.mapInArrow(_end_digests, "path binary, ends_sha256 string")

    below = nodes.groupBy(F.col("parent").alias("path")).agg(
        F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("single_children")
    )
    nodes = settle(nodes.join(below.where("path is not null"), "path", "left").join(ends, "path", "left"))
    children = F.coalesce("n_children", F.lit(0))
    childless = F.when(children == 0, F.lit(1)).otherwise(F.coalesce("single_children", F.lit(0)))
    sums = _subtree_sums(
        nodes.where("n_convs > 1").select(
            "path", "parent", ((F.col("n_convs") - 1) * F.col("words")).alias("saved"), childless.alias("leaves")
        )
    ).select("path", "saved", "leaves")
    parents = nodes.where("n_children is not null").select(F.col("path").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.join(sums, "path", "left")
        .join(parents, "parent", "left")
        .select(
            "path",
            "parent",
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            children.cast("long").alias("n_children"),
            F.coalesce("leaves", F.lit(1)).cast("long").alias("n_leaves"),
            F.coalesce("saved", F.lit(0)).cast("long").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
    )


ORACLE_SQL = """
WITH RECURSIVE own AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS body,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
            md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, ''))) AS place
    FROM conversations WHERE conv_id IS NOT NULL),
members AS (
    SELECT conv_id, conv_id - conv_id % 20 AS donor, xor(list_reduce(flatten(list_prepend([4294967295],
        list_transform(range(1, strlen(conv_id::VARCHAR) + 1), lambda i:
            [ascii(substr(conv_id::VARCHAR, i::INT, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295) % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM own)),
rebuilt AS (
    SELECT m.conv_id, 0 AS part, o.place, o.role, o.body FROM members m JOIN own o ON o.conv_id = m.donor AND o.place <= m.h
    UNION ALL
    SELECT m.conv_id, 1, o.place, o.role, o.body FROM members m JOIN own o ON o.conv_id = m.conv_id AND o.place > m.h),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY part, place) AS d FROM rebuilt),
paths AS (
    SELECT conv_id, 0::BIGINT AS d, 'root' AS path, NULL::VARCHAR AS parent, 0::BIGINT AS words FROM members
    UNION ALL
    SELECT n.conv_id, n.d, md5(p.path || md5(strlen(n.role) || ':' || n.role || ':' || n.body)), p.path,
        len(regexp_extract_all(n.body, '[^\\x20\\x09-\\x0D]+'))
    FROM paths p JOIN numbered n ON n.conv_id = p.conv_id AND n.d = p.d + 1),
lengths AS (SELECT conv_id, max(d) AS last FROM paths GROUP BY 1),
nodes AS (
    SELECT path, any_value(parent) AS parent, min(paths.conv_id) AS conv_id, any_value(d) AS depth,
        count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved,
        sha256(coalesce(string_agg(paths.conv_id::VARCHAR, ',' ORDER BY paths.conv_id) FILTER (WHERE last = d), '')) AS ends_sha256
    FROM paths JOIN lengths USING (conv_id) GROUP BY path),
above AS (
    SELECT path, path AS top FROM nodes
    UNION ALL
    SELECT a.path, n.parent FROM above a JOIN nodes n ON n.path = a.top WHERE n.parent IS NOT NULL),
children AS (SELECT parent AS path, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY 1),
sums AS (
    SELECT a.top AS path, sum(n.saved) AS saved_tokens, count(*) FILTER (WHERE c.path IS NULL) AS n_leaves
    FROM above a JOIN nodes n ON n.path = a.path LEFT JOIN children c ON c.path = a.path GROUP BY 1)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children,
    s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s USING (path) LEFT JOIN children c USING (path) LEFT JOIN nodes p ON p.path = n.parent
"""
