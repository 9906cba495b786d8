"""Quality rules on how a public vocabulary cuts a text.

Text of the kind a vocabulary was made for is cut into few, long and varied pieces. Four
measures of the whole text say how far a document is from that: characters of words per
token, the share of byte-fallback tokens, the entropy of its tokens, and the entropy of the
tokens that end words. Entropies are in bits, with the Miller-Madow correction, so that short
texts compare with long ones. Words of prose end in many ways; shouted words, tables and words
with symbols hung on end in few, whatever the words are. A document is rejected when a measure
lies outside the band of its language - or of its script, where the language has none - by
more than chance explains for a text of its length.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from orderloom.llm.common import WORD, quoted, sliced, without
from orderloom.llm.pieces import model_of

WORDS = re.compile(WORD)
BLANKS = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50


@dataclass(frozen=True)
class Band:
    """Accepted range of the measures; ``slack`` standard errors outside it are still accepted."""

    least_chars_per_token: float
    most_chars_per_token: float
    most_byte_share: float
    least_entropy: float
    least_ending_entropy: float
    slack: float = 1.0


#: By language; measured on clean text of each, see the README.
LANGUAGES: dict[str, Band] = {
    "de": Band(1.75, 6.0, 0.10, 5.2, 4.6),
    "en": Band(1.75, 6.0, 0.10, 5.2, 4.7),
    "es": Band(1.60, 6.0, 0.10, 5.2, 4.6),
    "fr": Band(1.65, 6.0, 0.10, 5.2, 4.5),
}
#: By script, for languages without a band of their own: wide, only broken text is outside.
SCRIPTS: dict[str, Band] = {
    "LATIN": Band(1.2, 8.0, 0.3, 4.5, 4.3),
    "CYRILLIC": Band(1.0, 8.0, 0.5, 4.5, 4.0),
    "": Band(0.25, 8.0, 1.0, 3.0, 0.0),
}

MEASURES = {
    "n_words": "bigint",
    "word_chars": "bigint",
    "n_symbols": "bigint",
    "n_dup_lines": "bigint",
    "n_repeat_words": "bigint",
    "base_failed": "boolean",
    "kept": "boolean",
    "n_tokens": "bigint",
    "chars_per_token": "double",
    "byte_share": "double",
    "token_entropy": "double",
    "ending_entropy": "double",
    "reason": "string",
}


def repeated_words(texts_words: Sequence[list[str]]) -> np.ndarray:
    """Per text, the words that stand in a window of three words found twice or more in it."""
    sizes = np.fromiter(map(len, texts_words), np.int64, len(texts_words))
    codes: dict[str, int] = {}
    flat = np.fromiter(
        (codes.setdefault(w, len(codes)) for words in texts_words for w in words), np.int64, int(sizes.sum())
    )
    text = np.repeat(np.arange(len(sizes)), sizes)
    covered = np.zeros(len(flat) + 1, bool)
    if len(flat) > 2:
        windows = np.flatnonzero(text[2:] == text[:-2])
        a, b, c, t = flat[windows], flat[windows + 1], flat[windows + 2], text[windows]
        # Sorted by a mix of the four; neighbours are then compared for real.
        mix = np.zeros(len(windows), np.uint64)
        for part in (a, b, c, t):
            mix = (mix ^ part.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            mix ^= mix >> np.uint64(29)
        order = np.argsort(mix, kind="stable")
        first, second = order[:-1], order[1:]
        same = (a[first] == a[second]) & (b[first] == b[second]) & (c[first] == c[second]) & (t[first] == t[second])
        twice = windows[np.union1d(first[same], second[same])]
        for step in range(3):
            covered[twice + step] = True
    return np.bincount(text, weights=covered[:-1], minlength=len(sizes)).astype(np.int64)


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return len(lines) - len(set(lines))


@lru_cache(maxsize=100_000)
def _script_of(letter: str) -> str:
    return unicodedata.name(letter, "").split(" ")[0]


def script_of(text: str) -> str:
    """The script most letters of the whole text are in, by their Unicode names; none is ''."""
    seen: dict[str, int] = {}
    for letter, n in Counter(text).items():
        if letter.isalpha():
            script = _script_of(letter)
            seen[script] = seen.get(script, 0) + n
    return max(seen, key=lambda s: (seen[s], s), default="")


def band_of(lang: str | None, text: str, languages: Mapping[str, Band], scripts: Mapping[str, Band]) -> Band:
    if lang in languages:
        return languages[lang]
    return scripts.get(script_of(text), scripts[""])


def entropy_of(ids: np.ndarray) -> tuple[float, float]:
    """Miller-Madow entropy in bits, and its standard error."""
    counts = np.unique(ids, return_counts=True)[1]
    share = counts / len(ids)
    surprise = -np.log2(share)
    plain = float((share * surprise).sum())
    spread = float((share * surprise**2).sum()) - plain**2
    return plain + (len(counts) - 1) / (2 * len(ids) * math.log(2)), math.sqrt(max(spread, 0) / len(ids))


def ending_tokens(model, ids: np.ndarray) -> np.ndarray:
    """The tokens before white space or the end, white space itself left out."""
    opens, blank = _token_kinds(model)
    before = np.append(opens[ids[1:]], True)
    return ids[before & ~blank[ids]]


def _token_kinds(model) -> tuple[np.ndarray, np.ndarray]:
    """By id: begins with white space, is nothing but white space."""
    if not hasattr(model, "kinds"):
        spaces = BLANKS.encode()
        model.kinds = (
            np.array([bool(s) and s[:1] in (spaces[i : i + 1] for i in range(len(spaces))) for s in model.surface]),
            np.array([not s.strip(spaces) for s in model.surface]),
        )
    return model.kinds


def verdict(model, word_chars: int, ids: np.ndarray, sizes: np.ndarray, band: Band) -> tuple[float, float, float, float, str]:
    """(characters per token, byte share, two entropies, why it is rejected or '')."""
    n = len(ids)
    if not n:
        return 0.0, 0.0, 0.0, 0.0, ""
    chars, share = word_chars / n, int(model.is_byte[ids].sum()) / n
    chars_error = float(sizes.std()) / math.sqrt(n)
    entropy, entropy_error = entropy_of(ids)
    endings = ending_tokens(model, ids)
    ending, ending_error = entropy_of(endings) if len(endings) else (0.0, 0.0)
    why = ""
    if chars + band.slack * chars_error < band.least_chars_per_token:
        why = "short tokens"
    elif chars - band.slack * chars_error > band.most_chars_per_token:
        why = "long tokens"
    elif share - band.slack * math.sqrt(share * (1 - share) / n) > band.most_byte_share:
        why = "bytes"
    elif entropy + band.slack * entropy_error < band.least_entropy:
        why = "entropy"
    elif ending + band.slack * ending_error < band.least_ending_entropy:
        why = "ending entropy"
    return chars, share, entropy, ending, why


def measure(model, texts: Sequence[str], langs: Sequence[str | None], languages=LANGUAGES, scripts=SCRIPTS) -> Iterator[tuple]:
    """The values of ``MEASURES`` for every text."""
    words = [WORDS.findall(t) for t in texts]
    repeats = repeated_words(words).tolist()
    encoded = model.encode_batch(texts, markers=False)
    for text, lang, own, repeat, one in zip(texts, langs, words, repeats, encoded, strict=True):
        n, chars = len(own), sum(map(len, own))
        failed = n < LEAST_WORDS or 100 * repeat > MOST_REPEATED_PERCENT * n
        ids = one.ids
        sizes = np.frombuffer(one.covers, "<u4")
        band = band_of(lang, text, languages, scripts)
        per_token, share, entropy, ending, why = verdict(model, chars, ids, sizes, band)
        yield (
            n, chars, sum(map(text.count, SYMBOLS)), repeated_lines(text), repeat, failed, not failed and not why,
            len(ids), per_token, share, entropy, ending, "base" if failed else why,
        )


def assess(
    docs: DataFrame,
    model_path: str,
    languages: Mapping[str, Band] = LANGUAGES,
    scripts: Mapping[str, Band] = SCRIPTS,
    text_col: str = "text",
    lang_col: str | None = "lang",
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """Every row's ``carry`` columns (all, if None) and the columns of ``MEASURES``.

    NULL text is the empty text: no words, so it fails the base rules. NULL or unknown
    languages, or ``lang_col=None``, are judged by the script. Input columns named like a
    measure are replaced. No rows give no rows.
    """
    with open(model_path, "rb") as file:
        blob = docs.sparkSession.sparkContext.broadcast(file.read())
    carried = [c for c in without(docs, *MEASURES) if carry is None or c in carry]
    read = list(dict.fromkeys([*carried, text_col, *([lang_col] if lang_col else [])]))
    source = docs.select(*[quoted(c) for c in read])
    text_at, lang_at = read.index(text_col), read.index(lang_col) if lang_col else None
    made = StructType.fromDDL(", ".join(f"{n} {t}" for n, t in MEASURES.items()))
    schema = StructType([*docs.select(*[quoted(c) for c in carried]).schema.fields, *made.fields])
    width, languages, scripts = len(carried), dict(languages), dict(scripts)
    kinds = [{"bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string()}[t] for t in MEASURES.values()]

    def run(batches):
        model = model_of(blob.value)
        for batch in (part for whole_batch in batches for part in sliced(whole_batch, text_at)):
            texts = [t or "" for t in batch.column(text_at).to_pylist()]
            langs = [None] * len(texts) if lang_at is None else batch.column(lang_at).to_pylist()
            rows = list(measure(model, texts, langs, languages, scripts))
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:width], *arrays], names=[*batch.schema.names[:width], *MEASURES]
            )

    return source.mapInArrow(run, schema)


def keep_good(docs: DataFrame, model_path: str) -> DataFrame:
    """The rows that are kept, with the columns they came with."""
    own = without(docs, *MEASURES)
    return assess(docs, model_path).where("kept").select(*[quoted(c) for c in own])
