"""Toxic spans by a linear-chain conditional random field over words.

Labels say which documents are toxic, not where. Words and word beginnings that a fair share
of toxic documents and next to no other document hold mark the tokens; a two-state chain is
trained on windows around such tokens and on windows of clean text, with words, their
beginnings and endings as features, so that it also knows forms it has not seen. Its
forward-backward marginals say how likely each token of a text is toxic. The largest of a
document's marginals and the sum of those of its offending tokens give its score, by a logistic
fit to the documents' labels.

What is fitted comes from a bounded sample of labelled rows (``Sample``). Scoring reads every
text whole, a batch of texts side by side, one token of each per step.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderloom.llm.common import WORD, fold_of, quoted, whole, without
from orderloom.session import settle

TOKEN = re.compile(WORD)
TRIM = ".,;:!?\"'()[]{}*#$%&|<>-_~`"
BEGINNINGS, ENDINGS = (3, 4, 5, 6), (3,)
MOST_EMISSION = 30.0
CACHE_WORDS = 500_000


@dataclass(frozen=True)
class Sample:
    """Bounds of what is fitted: labelled rows of either class, and windows of a row."""

    toxic: int = 3_000
    clean: int = 9_000
    windows: int = 6
    radius: int = 8
    steps: int = 80


@dataclass(frozen=True)
class Model:
    """Weights of features for the toxic state, log transitions, and the document fit.

    Features are known by name, those of the sample's windows and no others: a word never seen
    says no more than any word does, and what the beginning or ending it shares with one says.
    """

    weights: dict[str, float]
    transitions: np.ndarray
    document: tuple[float, float, float] = (0.0, 1.0, 0.0)


def features_of(word: str) -> list[str]:
    """Features of one token, case and surrounding marks aside; the first, of every token, is what is usual."""
    word = word.lower().strip(TRIM)
    return ["", f"w{word}", *(f"b{word[:n]}" for n in BEGINNINGS if len(word) >= n), *(f"e{word[-n:]}" for n in ENDINGS if len(word) >= n)]


# Forward and backward over many chains at once


def marginals(emissions: np.ndarray, sizes: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Probability of the toxic state for every token of chains laid end to end.

    ``emissions`` are log odds of the toxic state; chains are stepped through side by side,
    the longest first, so that those still running are always the first ones.
    """
    alpha, beta, _ = _passes(emissions, sizes, transitions)
    toxic = alpha * beta
    return toxic / np.maximum(toxic + (1 - alpha) * (1 - beta), 1e-300)


def _passes(emissions: np.ndarray, sizes: np.ndarray, transitions: np.ndarray):
    """Normalised forward and backward shares of the toxic state; the layout of the chains."""
    step = np.exp(transitions)
    odds = np.exp(np.clip(emissions, -MOST_EMISSION, MOST_EMISSION))
    order = np.argsort(-sizes, kind="stable")
    starts = (np.cumsum(sizes) - sizes)[order]
    lengths = sizes[order]
    longest = int(lengths[0]) if len(lengths) else 0
    running = np.searchsorted(-lengths, -np.arange(longest), side="left")
    alpha, beta = np.empty(len(emissions)), np.empty(len(emissions))
    share = np.full(len(lengths), 0.5)
    for t in range(longest):
        n = running[t]
        at = starts[:n] + t
        a = share[:n]
        if t:
            clean = (1 - a) * step[0, 0] + a * step[1, 0]
            toxic = ((1 - a) * step[0, 1] + a * step[1, 1]) * odds[at]
        else:
            clean, toxic = 1 - a, a * odds[at]
        share = toxic / (clean + toxic)
        alpha[at] = share
    share = np.zeros(0)
    for t in range(longest - 1, -1, -1):
        n = running[t]
        at = starts[:n] + t
        # Chains that end here begin with an even share.
        b = np.concatenate([share, np.full(n - len(share), 0.5)])
        more = len(share)
        if more:
            nxt = starts[:more] + t + 1
            clean_next, toxic_next = 1 - share, share * odds[nxt]
            clean = step[0, 0] * clean_next + step[0, 1] * toxic_next
            toxic = step[1, 0] * clean_next + step[1, 1] * toxic_next
            b[:more] = toxic / (clean + toxic)
        beta[at] = b
        share = b
    return alpha, beta, (starts, lengths)


def train_chain(features: list[list[str]], marks: np.ndarray, sizes: np.ndarray, steps: int, l2: float = 1e-3) -> tuple[dict[str, float], np.ndarray]:
    """Weights and transitions by gradient ascent on the conditional likelihood (Adagrad)."""
    used: dict[str, int] = {}
    inverse = np.fromiter((used.setdefault(f, len(used)) for fs in features for f in fs), np.int64)
    counts = np.fromiter(map(len, features), np.int64, len(features))
    token = np.repeat(np.arange(len(features)), counts)
    weights, transitions = np.zeros(len(used)), np.zeros((2, 2))
    grown, grown_t = np.full(len(used), 1e-6), np.full((2, 2), 1e-6)
    starts = np.cumsum(sizes) - sizes
    inner = np.setdiff1d(np.arange(len(marks)), starts)  # tokens with a token before them
    seen = np.zeros((2, 2))
    np.add.at(seen, (marks[inner - 1], marks[inner]), 1)
    for _ in range(steps):
        emissions = np.bincount(token, weights[inverse], len(features))
        alpha, beta, _ = _passes(emissions, sizes, transitions)
        toxic = alpha * beta
        toxic = toxic / (toxic + (1 - alpha) * (1 - beta))
        gradient = np.bincount(inverse, (marks - toxic)[token], len(used)) - l2 * weights
        # Expected transitions: what ends before, the step, what begins after.
        odds = np.exp(np.clip(emissions, -MOST_EMISSION, MOST_EMISSION))
        before = np.stack([1 - alpha[inner - 1], alpha[inner - 1]], 1)
        after = np.stack([1 - beta[inner], beta[inner] * odds[inner]], 1)
        joint = before[:, :, None] * np.exp(transitions)[None] * after[:, None, :]
        joint /= joint.sum((1, 2), keepdims=True)
        gradient_t = seen - joint.sum(0) - l2 * transitions
        grown += gradient**2
        grown_t += gradient_t**2
        weights += 0.5 * gradient / np.sqrt(grown)
        transitions += 0.1 * gradient_t / np.sqrt(grown_t)
    return dict(zip(used, weights.tolist(), strict=True)), transitions


def fit_document(largest: np.ndarray, total: np.ndarray, toxic: np.ndarray) -> tuple[float, float, float]:
    """Logistic weights of (1, log odds of the largest marginal, log of the sum), by Newton steps."""
    x = np.stack([np.ones(len(largest)), _log_odds(largest), np.log(total + 1e-4)], 1)
    w, ridge = np.zeros(3), np.diag([1e-3, 1e-2, 1e-2])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * len(x) / 100 + 1e-9 * np.eye(3)
        w += np.linalg.solve(hessian, x.T @ (toxic - p) - ridge @ w * len(x) / 100)
    return float(w[0]), float(w[1]), float(w[2])


def _log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


# Scoring


class Scorer:
    def __init__(self, model: Model):
        self.model, self.cache = model, {}

    def emission(self, word: str) -> float:
        value = self.cache.get(word)
        if value is None:
            if len(self.cache) > CACHE_WORDS:
                self.cache.clear()
            known = self.model.weights
            value = self.cache[word] = sum(known.get(f, 0.0) for f in features_of(word))
        return value

    def tokens(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of all tokens, texts laid end to end, and tokens per text."""
        lists = [TOKEN.findall(t) for t in texts]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        emissions = np.fromiter((self.emission(w) for words in lists for w in words), np.float64, int(sizes.sum()))
        return marginals(emissions, sizes, self.model.transitions), sizes

    def documents(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, list[list[tuple[int, int]]]]:
        """Per text: largest marginal, sum of marginals, spans of tokens more likely toxic than not.

        The sum is over those tokens: thousands of small marginals say no more than one.
        """
        likely, sizes = self.tokens(texts)
        offending = np.where(likely >= 0.5, likely, 0.0)
        largest, total = np.zeros(len(texts)), np.zeros(len(texts))
        filled = np.flatnonzero(sizes)
        if len(filled):
            starts = (np.cumsum(sizes) - sizes)[filled]
            largest[filled] = np.maximum.reduceat(likely, starts)
            total[filled] = np.add.reduceat(offending, starts)
        stops = np.cumsum(sizes)
        spans = [
            _spans(text, likely[stop - size : stop]) if top >= 0.5 else []
            for text, top, size, stop in zip(texts, largest, sizes, stops, strict=True)
        ]
        return largest, total, spans

    def score(self, largest: np.ndarray, total: np.ndarray) -> np.ndarray:
        a, b, c = self.model.document
        return 1 / (1 + np.exp(-np.clip(a + b * _log_odds(largest) + c * np.log(total + 1e-4), -30, 30)))


def _spans(text: str, likely: np.ndarray) -> list[tuple[int, int]]:
    """Character offsets of runs of toxic tokens."""
    found: list[tuple[int, int]] = []
    before = False
    for m, p in zip(TOKEN.finditer(text), likely, strict=True):
        if p >= 0.5:
            if before:
                found[-1] = (found[-1][0], m.end())
            else:
                found.append(m.span())
        before = p >= 0.5
    return found


# Fitting


def _labelled(docs: DataFrame, labels: DataFrame, sample: Sample, id_col: str, text_col: str) -> DataFrame:
    """(text, toxic) of at most ``sample.toxic`` and ``sample.clean`` rows outside fold 0, by hash. Settled."""
    known = labels.where("toxic in (0, 1)").select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(F.col("id").isNotNull() & (fold_of(F.col("id")) != 0))
    by_hash = [F.xxhash64(F.lit(10), "id"), F.col("id")]
    chosen = [
        known.where(F.col("toxic") == kind).orderBy(*by_hash).limit(most)
        for kind, most in ((1, sample.toxic), (0, sample.clean))
    ]
    chosen = chosen[0].unionByName(chosen[1])
    # At most sample.toxic + sample.clean ids.
    texts = docs.select(quoted(id_col).alias("id"), whole(quoted(text_col)).alias("text"))
    return settle(texts.join(F.broadcast(chosen), "id").select("text", "toxic"))


def _marking(rows: DataFrame) -> tuple[set[str], set[str]]:
    """Words, and word beginnings, that mark toxic documents of the sample."""

    def pieces(batches):
        for batch in batches:
            texts, kinds = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            names, toxic = [], []
            for text, kind in zip(texts, kinds, strict=True):
                words = {w.lower().strip(TRIM) for w in TOKEN.findall(text)}
                own = {f"w{w}" for w in words} | {f"b{w[:n]}" for w in words for n in BEGINNINGS if len(w) > n}
                names += own
                toxic += [kind] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(toxic, pa.int32())], names=["name", "toxic"])

    # One toxic row in a hundred holds a mark at least, and four: fewer may be chance.
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    positive, negative = sizes.get(1, 0), sizes.get(0, 0)
    least = max(4, math.ceil(0.01 * positive))
    counted = rows.select("text", "toxic").mapInArrow(pieces, "name string, toxic int").groupBy("name").agg(
        F.sum("toxic").alias("hits"), F.sum(1 - F.col("toxic")).alias("misses")
    )
    rate = F.col("hits") / max(positive, 1)
    clean_rate = F.col("misses") / max(negative, 1)
    # Each covers a hundredth of the toxic rows at least, and a row has bounded kinds of marks.
    marks = counted.where((F.col("hits") >= least) & (clean_rate * 40 < rate)).select("name").collect()
    names = [r["name"] for r in marks]
    return {n[1:] for n in names if n[0] == "w"}, {n[1:] for n in names if n[0] == "b"}


def _windows(rows: DataFrame, words: set[str], beginnings: set[str], sample: Sample) -> list[tuple[list[str], list[int]]]:
    """(tokens, marks) of up to ``sample.windows`` windows a row: around marks, or spread over clean text.

    A toxic row without a mark says nothing: its tokens would count as clean.
    """
    radius = sample.radius

    def cut(batches):
        for batch in batches:
            tokens, marks = [], []
            for text, kind in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = TOKEN.findall(text)
                plain = [w.lower().strip(TRIM) for w in own]
                hit = [int(w in words or any(w[:n] in beginnings for n in BEGINNINGS if len(w) > n)) for w in plain]
                if kind and not any(hit):
                    continue
                centres = [i for i, h in enumerate(hit) if h][:: max(1, sum(hit) // sample.windows)] if kind else []
                centres = centres[: sample.windows - 1] + [len(own) // 2, zlib.crc32(text.encode()) % max(1, len(own))]
                for c in centres[: sample.windows]:
                    low, high = max(0, c - radius), c + radius + 1
                    if own[low:high]:
                        tokens.append(own[low:high])
                        marks.append([h * kind for h in hit[low:high]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens, pa.list_(pa.string())), pa.array(marks, pa.list_(pa.int32()))], names=["tokens", "marks"]
            )

    made = rows.select("text", "toxic").mapInArrow(cut, "tokens array<string>, marks array<int>").toArrow()
    return list(zip(made["tokens"].to_pylist(), made["marks"].to_pylist(), strict=True))


def fit(docs: DataFrame, labels: DataFrame, sample: Sample = Sample(), id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The chain and the document fit, from labelled rows whose fold is not 0.

    Labels other than 0 and 1, NULL ids and ids without a document are left out. Without
    toxic or without clean rows the model finds nothing toxic.
    """
    rows = _labelled(docs, labels, sample, id_col, text_col)
    words, beginnings = _marking(rows)
    windows = _windows(rows, words, beginnings, sample)
    nothing = Model({}, np.zeros((2, 2)), (-30.0, 0.0, 0.0))
    if not any(1 in marks for _, marks in windows) or not any(1 not in marks for _, marks in windows):
        return nothing
    known: dict[str, list[str]] = {}
    features = [known.get(t) or known.setdefault(t, features_of(t)) for tokens, _ in windows for t in tokens]
    marks = np.fromiter((m for _, ms in windows for m in ms), np.int64)
    sizes = np.fromiter((len(ms) for _, ms in windows), np.int64, len(windows))
    weights, transitions = train_chain(features, marks, sizes, sample.steps)
    chain = Model(weights, transitions)

    def measured(batches):
        scorer = Scorer(chain)
        for batch in batches:
            largest, total, _ = scorer.documents(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(largest), pa.array(total), batch.column(1)], names=["largest", "total", "toxic"])

    seen = rows.select("text", "toxic").mapInArrow(measured, "largest double, total double, toxic int").toArrow()
    largest, total, toxic = (seen[n].to_numpy().astype(float) for n in ("largest", "total", "toxic"))
    return Model(weights, transitions, fit_document(largest, total, toxic))


SCORES = {"score": "double", "predicted": "int", "largest_marginal": "double", "n_spans": "bigint", "spans": "array<struct<begin:bigint,end:bigint>>"}


def score(docs: DataFrame, model: Model, text_col: str = "text", carry: Sequence[str] | None = None) -> DataFrame:
    """Every row's ``carry`` columns (all, if None) with the columns of ``SCORES``.

    Spans are character offsets. NULL text is the empty text: no tokens, no spans, and the
    score of a text without anything toxic. Input columns named like a score are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    carried = [c for c in without(docs, *SCORES) if carry is None or c in carry]
    read = list(dict.fromkeys([*carried, text_col]))
    text_at, width = read.index(text_col), len(carried)
    made = StructType.fromDDL(", ".join(f"{n} {t}" for n, t in SCORES.items()))
    schema = StructType([*docs.select(*[quoted(c) for c in carried]).schema.fields, *made.fields])
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(text_at).to_pylist()]
            largest, total, spans = scorer.documents(texts)
            scores = scorer.score(largest, total)
            arrays = [
                pa.array(scores),
                pa.array((scores >= 0.5).astype(np.int32)),
                pa.array(largest),
                pa.array([len(s) for s in spans], pa.int64()),
                pa.array([[{"begin": b, "end": e} for b, e in s] for s in spans], span),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *arrays], names=[*batch.schema.names[:width], *SCORES])

    return docs.select(*[quoted(c) for c in read]).mapInArrow(run, schema)
