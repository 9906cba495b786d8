"""Spelling variants by a variable-length gram index.

Words one edit apart (one code point inserted, deleted or replaced) are near. The index:

*Dictionary.* Grams are counted over all words. A gram held by many words makes a long list, so
it is not used as it is but extended, letter by letter, until its list is short or it has
``MOST_GRAM`` letters. Kept are the frequent grams that are extended: at most
``DICTIONARY`` per length, because each stands for more than 1 / ``DICTIONARY`` of all grams.

*Decomposition.* A word is cut into variable grams twice: from its beginning, each gram
extended to the right, and from its end, each extended to the left. An edit cannot move what
lies before it in the first cut, nor what lies behind it in the second.

*Affected grams.* For each edit position a word knows which grams the edit may touch: those of
the first cut that are not settled before it, and those of the second that are not settled
behind it. All others must be in any near word too, at the same distance from their end.
Neighbouring positions with the same grams left are one range of positions.

*List merging.* The bound says that a near word is in the lists of all the grams that are left,
so the lists are merged by the hash of those grams and the length: words of one merged list
agree but for a window of one or two grams.

*Verification.* Inside a merged list two words are near if, for a position in both their ranges,
they are equal without the letter there. Equal neighbours make a deletion ambiguous, so only
the first of a run of letters counts and every pair is met once. A task hands over counts and the
best near word of each word, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import ascii_lower, quoted, whole
from orderloom.session import settle

#: Letters of a word: fixed by what the operator is asked for.
LETTERS = r"A-Za-zÀ-ÿ"
LEAST_LETTERS = 7
LEAST_COUNT = 2
FORM_RATIO = 10

LEAST_GRAM, MOST_GRAM = 2, 4
DICTIONARY = 1 << 12
#: Entries a task hands over at a time.
BATCH_ROWS = 100_000
MOST_ROUNDS = 64

ENTRIES = "key long, check long, id long, n long, low int, high int, gap boolean, start int, body string"
FOUND = "id long, n_near long, best_n long, best long"


# Words


def words_of(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT
) -> DataFrame:
    """(word, n) of all whole texts, settled: runs of letters, A-Z in lower case, one run in 31 misspelt.

    The misspelling is the operator's test of itself: of a run whose crc32 with its id is
    divisible by 31 one code point goes. Runs that cannot end long enough are not looked at
    further. NULL texts have no words; a NULL id is the empty text in the crc32.
    """
    run = F.explode(F.regexp_extract_all(whole(quoted(text_col)), F.lit(f"[{LETTERS}]{{{least_letters},}}"), F.lit(0)))
    runs = docs.select(quoted(id_col).cast("string").alias("id"), run.alias("run"))
    # A run that a document repeats is spelt alike there.
    runs = runs.select("id", ascii_lower(F.col("run")).alias("run"))
    h = F.crc32(F.concat_ws(":", F.coalesce("id", F.lit("")), "run"))
    at = (h % F.length("run")).cast("int")
    cut = F.concat(F.expr("left(run, at)"), F.expr("substring(run, at + 2)"))
    spelt = runs.withColumn("h", h).withColumn("at", at).select(F.when(F.col("h") % 31 == 0, cut).otherwise(F.col("run")).alias("word"))
    counted = spelt.where(F.length("word") >= least_letters).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return settle(counted.where(F.col("n") >= least_count))


# Dictionary and decomposition


def frequent_grams(words: DataFrame, dictionary: int = DICTIONARY) -> set[str]:
    """Grams that are extended: more than 1 / ``dictionary`` of all grams of their length are equal to them.

    So a length has less than ``dictionary`` of them, whatever the number of words, and they fit
    in every task.
    """
    length = F.length("word")
    found: set[str] = set()
    for q in range(LEAST_GRAM, MOST_GRAM):
        fits = words.where(length >= q)
        total = fits.agg(F.sum(length - (q - 1))).first()[0] or 0
        gram = F.explode(F.transform(F.sequence(F.lit(1), length - (q - 1)), lambda p, q=q: F.substring("word", p, F.lit(q))))
        counted = fits.select(gram.alias("gram")).groupBy("gram").count()
        often = counted.where(F.col("count") > max(1, total // dictionary)).collect()
        found |= {r["gram"] for r in often}
    return found


def cuts_from_left(word: str, frequent: set[str]) -> list[int]:
    """Ends of the grams cut from the beginning; a rest that would need more letters is no gram."""
    ends, start, n = [], 0, len(word)
    while start + LEAST_GRAM <= n:
        size = LEAST_GRAM
        while size < MOST_GRAM and word[start : start + size] in frequent:
            size += 1
        start += size
        if start > n:
            break
        ends.append(start)
    return ends


def cuts_from_right(word: str, frequent: set[str]) -> list[int]:
    """Starts of the grams cut from the end, each extended to the left."""
    starts, end = [], len(word)
    while end >= LEAST_GRAM:
        size = LEAST_GRAM
        while size < MOST_GRAM and end - size >= 0 and word[end - size : end] in frequent:
            size += 1
        end -= size
        if end < 0:
            break
        starts.append(end)
    return starts


def edit_ranges(word: str, frequent: set[str]) -> Iterator[tuple[int, int, int, int, bool]]:
    """(low, high, left, right, gap): for edits at low to high, the grams before ``left`` and from ``right`` on are left.

    First for the word's own letters (each may be replaced, or be the one too many), then for
    the gaps between them (where a letter may be missing; ``gap``).
    """
    n = len(word)
    ends, starts = [0, *cuts_from_left(word, frequent)], [n, *cuts_from_right(word, frequent)]
    for gap in (False, True):
        low, at, b = 0, 0, len(starts) - 1
        before = None
        for i in range(n + gap):
            while at + 1 < len(ends) and ends[at + 1] <= i:
                at += 1
            behind = i if gap else i + 1
            while starts[b] < behind:
                b -= 1
            left = (ends[at], starts[b])
            if left != before:
                if before is not None:
                    yield low, i - 1, *before, gap
                low, before = i, left
        if before is not None:
            yield low, n - 1 + gap, *before, gap


MASK = (1 << 64) - 1
STEPS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
ROW_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.string()]


def _names(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.split(", ")]


def _running(letters: Iterable[str], step: int) -> list[int]:
    """Hashes of all beginnings, so that a word of any length costs its length."""
    hashes = [0]
    for c in letters:
        hashes.append(((hashes[-1] + ord(c) + 1) * step) & MASK)
    return hashes


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def entries_of(word: str, frequent: set[str]) -> Iterator[tuple[int, int, int, int, bool, int, str]]:
    """(key, check, low, high, gap, start, body) for each range of edit positions of a word.

    ``key`` and ``check`` are hashes of the grams that are left and of how many letters stay;
    ``body`` is the rest, the window of the edit, from ``start`` on with one letter before it.
    """
    size = len(word)
    (heads, tails), (heads2, tails2) = [(_running(word, step), _running(reversed(word), step)) for step in STEPS]
    for low, high, left, right, gap in edit_ranges(word, frequent):
        length = size if gap else size - 1
        key = heads[left] ^ ((tails[size - right] * 3 + length * STEPS[1] + left) & MASK)
        key = ((key ^ (key >> 29)) * STEPS[0]) & MASK
        check = heads2[left] ^ ((tails2[size - right] * 5 + length * STEPS[0] + left) & MASK)
        start = max(left - 1, 0)
        yield _signed(key ^ (key >> 32)), _signed(check), low, high, gap, start, word[start:right]


def _entries(frequent: set[str]):
    """Entries of the merged lists for batches of (id, word, n)."""

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(zip(*rows, strict=True), ROW_TYPES, strict=True)], names=_names(ENTRIES)
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for id_, word, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                for key, check, low, high, gap, start, body in entries_of(word, frequent):
                    rows.append((key, check, id_, n, low, high, gap, start, body))
                if len(rows) >= BATCH_ROWS:
                    yield packed(rows)
                    rows = []
        if rows:
            yield packed(rows)

    return run


# Verification


def near_in_list(members: list[tuple[int, int, int, int, int, bool, int, str]]) -> Iterator[tuple[int, int, int, int]]:
    """(id, near words, count of the best, id of the best) for the words of one merged list.

    Members are (check, id, n, low, high, gap, start, body). Words that leave the same letters
    at the same position are near one another; a gap leaves all of its letters. Of equal counts
    the smaller id is best: ids rise in code-point order.
    """
    meets: dict[tuple[int, int, str], list[tuple[int, int, bool, bool]]] = {}
    for check, id_, n, low, high, gap, start, body in members:
        for i in range(low, high + 1):
            at = i - start
            rest = body if gap else body[:at] + body[at + 1 :]
            # The first of a run of equal letters stands for the deletion of any of them.
            first = gap or at == 0 or body[at - 1] != body[at]
            meets.setdefault((i, check, rest), []).append((-n, id_, gap, first))
    for met in meets.values():
        if len(met) < 2:
            continue
        replaced = sorted(m for m in met if not m[2])
        if len(replaced) > 1:
            for at, m in enumerate(replaced):
                best = replaced[1 if at == 0 else 0]
                yield m[1], len(replaced) - 1, -best[0], best[1]
        # A gap leaves the whole word, so one word at most is in this place by its gap.
        shorter = next((m for m in met if m[2]), None)
        longer = [m for m in replaced if m[3]] if shorter else []
        for m in longer:
            yield m[1], 1, -shorter[0], shorter[1]
        if longer:
            yield shorter[1], len(longer), -longer[0][0], longer[0][1]


def _meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merged lists come in order of their key; a list is held until the next key comes."""
    found: list[tuple] = []

    def packed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*found, strict=True)], names=_names(FOUND))

    def rows(batch: pa.RecordBatch, start: int, stop: int) -> list[tuple]:
        part = batch.slice(start, stop - start)
        return list(zip(*(part.column(i).to_pylist() for i in range(1, 9)), strict=True))

    at, held = None, []
    for batch in batches:
        keys = batch.column(0).to_numpy()
        if not len(keys):
            continue
        edges = np.flatnonzero(np.diff(keys)) + 1
        starts, stops = np.concatenate([[0], edges]), np.concatenate([edges, [len(keys)]])
        if held and keys[0] == at:
            held += rows(batch, 0, int(stops[0]))
            starts, stops = starts[1:], stops[1:]
            if not len(starts):
                continue
        if len(held) > 1:
            found += near_in_list(held)
        at, held = keys[-1], rows(batch, int(starts[-1]), int(stops[-1]))
        # All but the last list end in this batch; lists of one word have nothing to meet.
        met = np.flatnonzero(np.diff(starts) > 1)
        if len(met):
            inside = np.concatenate([np.arange(starts[m], stops[m]) for m in met])
            members = list(zip(*(batch.column(i).take(pa.array(inside)).to_pylist() for i in range(1, 9)), strict=True))
            to = 0
            for size in (stops[met] - starts[met]).tolist():
                found += near_in_list(members[to : to + size])
                to += size
        if len(found) >= BATCH_ROWS:
            yield packed()
            found.clear()
    if len(held) > 1:
        found += near_in_list(held)
    if found:
        yield packed()


def numbered(words: DataFrame) -> DataFrame:
    """(id, word, n) with ids that rise in code-point order. Settled."""
    ordered = words.select("word", "n").repartitionByRange("word").sortWithinPartitions("word")
    return settle(ordered.select(F.monotonically_increasing_id().alias("id"), "word", "n"))


def near_words(words: DataFrame, dictionary: int = DICTIONARY) -> DataFrame:
    """(id, n_near, best_n, best) of every word of (id, word, n) that has a near word.

    ``best`` is the id of the near word of largest n, of equal ones the first in code-point
    order. Words are distinct and not NULL. Letters outside the window of an edit are compared
    by 128 bits of hash, those inside it one by one.
    """
    frequent = frequent_grams(words, dictionary)
    entries = words.select("id", "word", "n").mapInArrow(_entries(frequent), ENTRIES)
    lists = entries.repartition("key").sortWithinPartitions("key")
    found = lists.mapInArrow(_meet, FOUND)
    best = F.min(F.struct((-F.col("best_n")).alias("negative"), F.col("best"))).alias("first")
    return found.groupBy("id").agg(F.sum("n_near").alias("n_near"), best).select(
        "id", "n_near", (-F.col("first.negative")).alias("best_n"), F.col("first.best").alias("best")
    )


# Forms and roots


def roots(forms: DataFrame) -> DataFrame:
    """(id, root) of every word of (id, form): the end of its chain of forms.

    A form is larger than its word, so chains end; they halve from round to round.
    """
    known = settle(forms.select("id", F.col("form").alias("root")))
    for _ in range(MOST_ROUNDS):
        step = known.select(F.col("id").alias("root"), F.col("root").alias("further"))
        further = settle(
            known.join(step, "root", "left").select("id", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        )
        known = further.select("id", "root")
        if further.where("moved").isEmpty():
            return known
    raise RuntimeError(f"forms are chained more than 2^{MOST_ROUNDS} times")


def variants(words: DataFrame, ratio: int = FORM_RATIO, dictionary: int = DICTIONARY) -> DataFrame:
    """Every word of (word, n) with ``form``, ``root``, ``n_near`` and ``form_n``.

    A word's form is its best near word, if that occurs ``ratio`` times as often at least; its
    root is the last of the chain of forms, or itself. No words give no rows.
    """
    words = numbered(words)
    is_form = F.col("best_n") >= ratio * F.col("n")
    marked = settle(
        words.join(near_words(words, dictionary), "id", "left").select(
            "id",
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best")).alias("form_id"),
            F.when(is_form, F.col("best_n")).alias("form_n"),
        )
    )
    formed = marked.where("form_id is not null")
    ends = roots(formed.select("id", F.col("form_id").alias("form")))
    spelt = [words.select(F.col("id").alias(f"{name}_id"), F.col("word").alias(name)) for name in ("form", "root")]
    named = (
        formed.select("id", "form_id")
        .join(ends.withColumnRenamed("root", "root_id"), "id")
        .join(spelt[0], "form_id")
        .join(spelt[1], "root_id")
    )
    return marked.join(named.select("id", "form", "root"), "id", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def groups(found: DataFrame) -> DataFrame:
    """(root, words, n): how many spellings share a root, and their occurrences."""
    return found.groupBy("root").agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n"))



ORACLE_SQL = r"""
WITH RECURSIVE runs AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
    WHERE length(run) >= 7 GROUP BY 1, 2),
hashed AS (
    SELECT run, n, xor(list_reduce(flatten(list_prepend([4294967295], list_transform(range(1, strlen(bytes) // 2 + 1), lambda i:
            [('0x' || substr(bytes, (2 * i - 1)::INT, 2))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295) AS h
    FROM (SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS bytes FROM runs)),
words AS (
    SELECT word, sum(n)::BIGINT AS n FROM (
        SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run) + 2)::INT) ELSE run END AS word
        FROM hashed)
    WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
holes AS (
    SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM words)),
near AS (
    SELECT a.word, b.word AS other, b.n FROM holes a JOIN holes b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION
    SELECT h.word, w.word, w.n FROM holes h JOIN words w ON h.rest = w.word
    UNION
    SELECT w.word, h.word, h.n FROM holes h JOIN words w ON h.rest = w.word),
best AS (
    SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, encode(other)) AS other, max(n) AS other_n FROM near GROUP BY word),
marked AS (
    SELECT word, CASE WHEN other_n >= 10 * n THEN other END AS form, n, coalesce(n_near, 0) AS n_near,
        CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
    FROM words LEFT JOIN best USING (word)),
chains AS (
    SELECT word, word AS at FROM marked
    UNION ALL
    SELECT c.word, m.form FROM chains c JOIN marked m ON m.word = c.at WHERE m.form IS NOT NULL)
SELECT m.word, m.form, c.at AS root, m.n, m.n_near, m.form_n
FROM marked m JOIN chains c USING (word) JOIN marked e ON e.word = c.at AND e.form IS NULL
"""
