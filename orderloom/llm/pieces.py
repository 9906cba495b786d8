"""SentencePiece BPE encoding that keeps source offsets, and its decoding.

Text is normalised by longest prefixes of the model's compiled character map; every
normalised character remembers the source bytes it came from, so each piece maps back to a
span of the original UTF-8. The normalised text is cut where no piece can reach across, and
units not met before are merged together, a whole array of them per merge step.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from orderloom.llm.common import quoted, without

SPACE = "▁"
NORMAL, CONTROL, BYTE = 1, 3, 6
BPE = 2
#: Units a worker remembers; a full cache starts anew.
CACHE_UNITS = 400_000
#: Longer units are merged one by one with a heap.
WIDEST = 64
NO_PAIR = np.iinfo(np.int32).max


class CharMap:
    """The compiled map: a double-array trie over source bytes, then its replacement texts."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.texts = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest mapped prefix of ``data[at:]`` and its replacement."""
        units, found = self.units, None
        if not units:
            return None
        node = _child(units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units) or units[node] & 0x800000FF != data[i]:
                break
            unit = units[node]
            node ^= _child(unit)
            if unit >> 8 & 1:
                found = i + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        length, start = found
        return length, self.texts[start : self.texts.index(b"\0", start)]


def _unit_pattern(pieces: set[str], inside: set[str]) -> re.Pattern:
    """Matches stretches that no piece reaches across.

    Marked spaces begin a unit where no piece has one behind another character. Letters and
    what pieces mix with them form one class, the other characters of pieces a second one
    that no piece mixes with the first; a character of no longer piece stands alone.
    """
    if any(SPACE in t.lstrip(SPACE) for t in pieces):
        return re.compile("(?s:.+)")
    beside = {(a, b) for t in pieces for a, b in zip(t, t[1:], strict=False) if SPACE not in (a, b)}
    words = {c for c in inside if c.isalpha()}
    while more := {x for a, b in beside if (a in words) != (b in words) for x in (a, b)} - words:
        words |= more
    marks = inside - words
    classes = ["".join(map(re.escape, sorted(c))) for c in (words, marks) if c]
    runs = "|".join(f"[{c}]+" for c in classes)
    every = "".join(classes)
    return re.compile(f"{SPACE}*(?:{runs})|{SPACE}+|[^{every}{SPACE}]" if every else "(?s:.+)")


def _child(unit: int) -> int:
    return unit >> 10 << ((unit & 0x200) >> 6)


def utf8_lengths(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    return 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)


class PieceModel:
    def __init__(self, blob: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(blob)
        trainer, self.norm = proto.trainer_spec, proto.normalizer_spec
        kinds = {p.type for p in proto.pieces}
        if trainer.model_type != BPE or not trainer.byte_fallback or not kinds <= {1, 2, 3, 6}:
            raise ValueError("only BPE models with byte fallback and without user-defined pieces")
        if trainer.treat_whitespace_as_suffix or not self.norm.escape_whitespaces:
            raise ValueError("only models that mark spaces as prefixes")
        self.map = CharMap(self.norm.precompiled_charsmap)
        pieces = [(p.piece, p.type, p.score) for p in proto.pieces]
        self.size = len(pieces)
        self.begin = next(i for i, p in enumerate(pieces) if p[0] == trainer.bos_piece)
        self.end = next(i for i, p in enumerate(pieces) if p[0] == trainer.eos_piece)
        self.is_byte = np.array([kind == BYTE for _, kind, _ in pieces])
        self.byte_ids = np.zeros(256, np.uint32)
        self.surface = []
        for i, (text, kind, _) in enumerate(pieces):
            if kind == BYTE:
                self.byte_ids[int(text[1:-1], 16)] = i
            shown = {NORMAL: text.replace(SPACE, " ").encode(), CONTROL: b""}.get(kind, " ⁇ ".encode())
            self.surface.append(bytes([int(text[1:-1], 16)]) if kind == BYTE else shown)
        self._merges([(t, s, i) for i, (t, kind, s) in enumerate(pieces) if kind == NORMAL])
        self.cache: dict[str, tuple[bytes, bytes]] = {}

    def _merges(self, normal: list[tuple[str, float, int]]) -> None:
        known = {t: i for t, _, i in normal}
        inside = {c for t in known if len(t) > 1 for c in t}
        spare = iter(range(self.size, self.size + len(inside) + 1))
        self.symbols = {c: known[c] if c in known else next(spare) for c in sorted(inside | set(known)) if len(c) == 1}
        self.symbol_of = np.full(0x110000, -1, np.int32)
        self.symbol_of[[ord(c) for c in self.symbols]] = list(self.symbols.values())
        symbol = {**known, **self.symbols}
        # Best score first; equal scores share a rank, and the leftmost of them merges first.
        ranks = {s: r for r, s in enumerate(sorted({s for t, s, _ in normal if len(t) > 1}, reverse=True))}
        pairs = {}
        for text, score, i in normal:
            for cut in range(1, len(text)):
                left, right = symbol.get(text[:cut]), symbol.get(text[cut:])
                if left is not None and right is not None:
                    pairs[left << 20 | right] = (ranks[score], i)
        self.pair_table = pairs
        self.pair_keys = np.array(sorted(pairs) or [-1], np.int64)
        self.pair_rank = np.array([pairs[k][0] for k in sorted(pairs)] or [0], np.int32)
        self.pair_made = np.array([pairs[k][1] for k in sorted(pairs)] or [0], np.int32)
        self.unit = _unit_pattern(set(known), inside - {SPACE})

    # Normalising

    def normalise(self, text: str) -> tuple[str, np.ndarray | None]:
        """The normalised text, and per character the source byte it begins at, one more for the end.

        No offsets (None) stand for: character by character as in the source, after the
        dummy prefix.
        """
        if not text:
            return "", None
        if not self.map.units and not self.norm.remove_extra_whitespaces:
            plain = text.replace(" ", SPACE)
            return (SPACE + plain if self.norm.add_dummy_prefix else plain), None
        data, at, out, starts = text.encode(), 0, [], []
        squeeze = self.norm.remove_extra_whitespaces
        after_space, end = squeeze, 0
        while at < len(data):
            hit = self.map.longest(data, at)
            length = hit[0] if hit else _char_bytes(data[at])
            shown = (hit[1] if hit else data[at : at + length]).decode()
            if after_space:
                shown = shown.lstrip(" ")
            if shown:
                if not out and self.norm.add_dummy_prefix:
                    out.append(SPACE)
                    starts.append(at)
                out.extend(shown.replace(" ", SPACE))
                starts.extend([at] * len(shown))
                after_space = squeeze and shown.endswith(" ")
                end = at + length
            at += length
        while squeeze and out and out[-1] == SPACE and len(out) > 1:
            out.pop()
            end = starts.pop()
        if not out:
            return "", None
        return "".join(out), np.array([*starts, end], np.int64)

    # Merging

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left.astype(np.int64) << 20 | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        hit = (self.pair_keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.pair_rank[at], NO_PAIR), np.where(hit, self.pair_made[at], -1)

    def merge_all(self, units: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Matrices of symbols and of characters each covers, all units merged side by side.

        A symbol stays in the column it begins at; a column that was merged away is -2.
        """
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        n, width = len(units), int(lengths.max())
        points = np.frombuffer("".join(units).encode("utf-32-le"), "<u4")
        held = np.arange(width) < lengths[:, None]
        symbols = np.full((n, width + 1), -2, np.int32)
        symbols[:, :-1][held] = self.symbol_of[points]
        covers = (symbols > -2).astype(np.int32)
        rank = np.full((n, width + 1), NO_PAIR, np.int32)
        made = np.zeros((n, width + 1), np.int32)
        rank[:, :-1], made[:, :-1] = self._lookup(symbols[:, :-1], symbols[:, 1:])
        after = np.broadcast_to(np.arange(1, width + 2, dtype=np.int32), (n, width + 1)).copy()
        before = after - 2
        rows = np.arange(n)
        while len(rows):
            best = rank[rows].argmin(1)
            going = rank[rows, best] < NO_PAIR
            rows, best = rows[going], best[going]
            gone = after[rows, best]
            symbols[rows, best] = made[rows, best]
            covers[rows, best] += covers[rows, gone]
            symbols[rows, gone], rank[rows, gone] = -2, NO_PAIR
            beyond = after[rows, gone]
            after[rows, best] = beyond
            before[rows, np.minimum(beyond, width)] = best
            rank[rows, best], made[rows, best] = self._lookup(
                symbols[rows, best], symbols[rows, np.minimum(beyond, width)]
            )
            left = before[rows, best]
            r, c = rows[left >= 0], left[left >= 0]
            rank[r, c], made[r, c] = self._lookup(symbols[r, c], symbols[r, after[r, c]])
        return symbols, covers

    def merge_long(self, unit: str) -> tuple[np.ndarray, np.ndarray]:
        """The same merges for one long unit: a heap of pairs over linked symbols."""
        symbols = [self.symbols.get(c, -1) for c in unit]
        covers, n = [1] * len(unit), len(unit)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if i >= 0 and j < n and symbols[i] >= 0 and symbols[j] >= 0:
                if pair := self.pair_table.get(symbols[i] << 20 | symbols[j]):
                    heapq.heappush(heap, (pair[0], i, covers[i] + covers[j], pair[1]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, size, made = heapq.heappop(heap)
            j = after[i] if covers[i] else n
            if j >= n or covers[i] + covers[j] != size:
                continue
            if (pair := self.pair_table.get(symbols[i] << 20 | symbols[j])) is None or pair[1] != made:
                continue
            symbols[i], covers[i], covers[j] = made, size, 0
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        keep = [i for i in range(n) if covers[i]]
        return np.array([symbols[i] for i in keep], np.int32), np.array([covers[i] for i in keep], np.int32)

    def _learn(self, units: Sequence[str]) -> None:
        """Put the ids and character counts of new units into the cache."""
        by_width: dict[int, list[str]] = {}
        for unit in units:
            by_width.setdefault(max(8, 1 << (len(unit) - 1).bit_length()), []).append(unit)
        for width, group in by_width.items():
            if width > WIDEST:
                for unit in group:
                    self.cache[unit] = self._packed(unit, *self.merge_long(unit))
                continue
            for at in range(0, len(group), 8192):
                self._learn_side_by_side(group[at : at + 8192])

    def _learn_side_by_side(self, units: Sequence[str]) -> None:
        symbols, covers = self.merge_all(units)
        held = symbols > -2
        stops = [0, *(4 * np.cumsum(held.sum(1))).tolist()]
        odd = (held & ((symbols < 0) | (symbols >= self.size))).any(1)
        ids, sizes = symbols[held].astype("<u4").tobytes(), covers[held].astype("<u4").tobytes()
        self.cache.update(
            (unit, (ids[a:b], sizes[a:b])) for unit, a, b in zip(units, stops[:-1], stops[1:], strict=True)
        )
        for row in np.flatnonzero(odd).tolist():
            self.cache[units[row]] = self._packed(units[row], symbols[row, held[row]], covers[row, held[row]])

    def _packed(self, unit: str, symbols: np.ndarray, covers: np.ndarray) -> tuple[bytes, bytes]:
        """Ids and covered characters as bytes; a character without a piece becomes its bytes.

        Of a character's byte pieces the last one covers it and the others are empty.
        """
        if ((symbols >= 0) & (symbols < self.size)).all():
            return symbols.astype("<u4").tobytes(), covers.astype("<u4").tobytes()
        ids, sizes, at = [], [], 0
        for symbol, cover in zip(symbols.tolist(), covers.tolist(), strict=True):
            if 0 <= symbol < self.size:
                ids.append(symbol)
                sizes.append(cover)
            else:
                raw = unit[at].encode()
                ids += self.byte_ids[list(raw)].tolist()
                sizes += [0] * (len(raw) - 1) + [1]
            at += cover
        return np.array(ids, "<u4").tobytes(), np.array(sizes, "<u4").tobytes()

    # Encoding and decoding

    def units_of(self, normal: str) -> list[str]:
        return self.unit.findall(normal)

    def prepare(self, lists: Sequence[list[str]]) -> None:
        """Learn the units of a batch at once."""
        if len(self.cache) > CACHE_UNITS:
            self.cache.clear()
        new = set().union(*lists).difference(self.cache)
        if new:
            self._learn(sorted(new))

    def encode_batch(self, texts: Sequence[str], markers: bool = True) -> Iterator[Encoded]:
        for at in range(0, len(texts), 1000):
            part = texts[at : at + 1000]
            normal = [self.normalise(t) for t in part]
            lists = [self.units_of(n) for n, _ in normal]
            self.prepare(lists)
            for text, (_, offsets), units in zip(part, normal, lists, strict=True):
                found = [self.cache[u] for u in units]
                yield Encoded(self, text, b"".join([f[0] for f in found]), b"".join([f[1] for f in found]), offsets, markers)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: bytes that are no UTF-8 become U+FFFD each."""
        ids = np.asarray(ids, np.int64)
        shown = np.flatnonzero((ids != self.begin) & (ids != self.end))
        ids = ids[shown[0] : shown[-1] + 1] if len(shown) else ids[:0]
        parts = list(map(self.surface.__getitem__, ids.tolist()))
        strips = self.norm.add_dummy_prefix or self.norm.remove_extra_whitespaces
        if parts and strips and not self.is_byte[ids[0]] and parts[0].startswith(b" "):
            parts[0] = parts[0][1:]
        if len(shown) == len(ids):
            try:
                return b"".join(parts).decode()
            except UnicodeDecodeError:
                pass
        # Also where a marker stands between bytes, which then make no character together.
        return "".join(_lenient(parts, self.is_byte[ids]))


def _char_bytes(first: int) -> int:
    return 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4


def _lenient(parts: list[bytes], is_byte: np.ndarray) -> Iterator[str]:
    at = 0
    while at < len(parts):
        end = at + 1
        while is_byte[at] and end < len(parts) and is_byte[end]:
            end += 1
        run = b"".join(parts[at:end])
        i = 0
        while i < len(run):
            size = _char_bytes(run[i])
            try:
                yield run[i : i + size].decode()
                i += size
            except UnicodeDecodeError:
                yield "�"
                i += 1
        at = end


class Encoded:
    """Ids of one text, and on demand the source bytes each piece stands for."""

    def __init__(self, model, text, ids, covers, offsets, markers):
        self.model, self.text, self.covers, self.offsets, self.markers = model, text, covers, offsets, markers
        if markers:
            ids = model.begin.to_bytes(4, "little") + ids + model.end.to_bytes(4, "little")
        self.packed = ids

    @property
    def ids(self) -> np.ndarray:
        return np.frombuffer(self.packed, "<u4")

    def spans(self) -> tuple[np.ndarray, np.ndarray]:
        """First and past-the-last source byte of every id; markers are empty."""
        ends = np.cumsum(np.frombuffer(self.covers, "<u4").astype(np.int64))
        begins = ends - np.frombuffer(self.covers, "<u4")
        if self.offsets is not None:
            offsets = self.offsets
        else:
            dummy = int(bool(self.text) and self.model.norm.add_dummy_prefix)
            size = len(self.text.encode())
            if size == len(self.text):
                offsets = np.maximum(np.arange(size + dummy + 1) - dummy, 0)
            else:
                offsets = np.concatenate([np.zeros(dummy + 1, np.int64), np.cumsum(utf8_lengths(self.text))])
        begins, ends = offsets[begins], offsets[ends]
        if self.markers:
            last = offsets[-1:]
            begins, ends = np.concatenate([[0], begins, last]), np.concatenate([[0], ends, last])
        return begins, ends


@lru_cache(maxsize=4)
def model_of(blob: bytes) -> PieceModel:
    """One model per worker and file."""
    return PieceModel(blob)


def _list(arrays: list[np.ndarray], kind) -> pa.Array:
    offsets = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate(arrays) if arrays else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))


OUTPUTS = {
    "ids": "array<bigint>",
    "begins": "array<bigint>",
    "ends": "array<bigint>",
    "decoded": "string",
    "n_tokens": "bigint",
    "ids_sha256": "string",
    "decoded_sha256": "string",
    "n_bytes": "bigint",
    "covered_bytes": "bigint",
    "spans_crc32": "bigint",
}
KINDS = {"array<bigint>": pa.list_(pa.int64()), "string": pa.string(), "bigint": pa.int64()}


def _outputs(model: PieceModel, texts: list[str], wanted: Sequence[str]) -> dict[str, list]:
    rows: dict[str, list] = {w: [] for w in wanted}
    spanning = {"begins", "ends", "covered_bytes", "spans_crc32"} & set(wanted)
    decoding = {"decoded", "decoded_sha256"} & set(wanted)
    for one in model.encode_batch(texts):
        made = {"n_tokens": len(one.packed) // 4}
        if "ids" in rows:
            made["ids"] = one.ids.astype(np.int64)
        if "ids_sha256" in rows:
            made["ids_sha256"] = hashlib.sha256(one.packed).hexdigest()
        if "n_bytes" in rows:
            made["n_bytes"] = len(one.text.encode())
        if decoding:
            made["decoded"] = model.decode(one.ids)
            made["decoded_sha256"] = hashlib.sha256(made["decoded"].encode()).hexdigest()
        if spanning:
            made["begins"], made["ends"] = one.spans()
            made["covered_bytes"] = int((made["ends"] - made["begins"]).sum())
            made["spans_crc32"] = zlib.crc32(np.stack([made["begins"], made["ends"]]).astype("<u4").tobytes())
        for name in wanted:
            rows[name].append(made[name])
    return rows


def encode(docs: DataFrame, model_path: str, outputs: Sequence[str] = ("ids", "begins", "ends"), text_col: str = "text") -> DataFrame:
    """Every row with the named ``outputs`` of its whole text; see ``OUTPUTS``.

    ``begins`` and ``ends`` are byte offsets into the text's UTF-8. NULL text is the empty
    text, which has the begin and end ids only. The text column is dropped, input columns
    named like an output are replaced, other columns stay as they are. ``covered_bytes``
    sums the spans, ``spans_crc32`` is over all begins, then all ends, as 32-bit integers.
    """
    with open(model_path, "rb") as file:
        blob = docs.sparkSession.sparkContext.broadcast(file.read())
    kept = [c for c in without(docs, *outputs) if c != text_col]
    source = docs.select(quoted(text_col).alias("_text"), *[quoted(c) for c in kept])
    made = StructType.fromDDL(", ".join(f"{name} {OUTPUTS[name]}" for name in outputs))
    schema = StructType([*source.drop("_text").schema.fields, *made.fields])

    def run(batches):
        model = model_of(blob.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            rows = _outputs(model, texts, outputs)
            arrays = [
                _list(rows[n], pa.int64()) if OUTPUTS[n].startswith("array") else pa.array(rows[n], KINDS[OUTPUTS[n]])
                for n in outputs
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *arrays], names=[*batch.schema.names[1:], *outputs])

    return source.mapInArrow(run, schema)
