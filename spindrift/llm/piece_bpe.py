"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text is cut into segments that no merge can cross (a segment starts where white space starts); a worker encodes each
distinct segment once and remembers a bounded number of them. The segments that are new are laid out as one flat
array of symbols and cut once more wherever no piece holds the two characters side by side, so that a long run without
white space falls into short ones. Each round finds the best rank of every segment by a segmented minimum, merges all
pairs of that rank from the left, compacts the array, and drops segments without a pair. A merge may make a pair that is
better than the one just used; the library takes that one before the equal pairs to the right, so in such a segment
those wait for a later round. Texts and segments of any length go this one way.

Defined results: null and empty texts give no ids and decode to the empty text; repeated rows and texts of any length
are encoded whole; pairs of equal rank merge from the left; an empty table gives an empty result; extra columns, whatever
their names, are kept by ``encode_documents`` unless named ``ids`` or ``decoded`` in any case.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import apart

#: Distinct segments that a worker remembers before it starts afresh.
REMEMBERED = 300_000
#: Segments, and ids, that are looked at together.
SLICE = 400_000
#: Symbols that merge together.
TOGETHER = 1 << 17
SPACE = "▁"
_NONE = np.iinfo(np.int64).max


class LongTable:
    """An open hash table of longs in arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(2 * len(keys) + 1))))
        self.key = np.full(1 << self.bits, -1, dtype=np.int64)
        self.value = np.full(1 << self.bits, -1, dtype=np.int64)
        at = self._slot(keys)
        while len(keys):
            free = self.key[at] == -1
            _, first = np.unique(np.where(free, at, -1 - np.arange(len(at))), return_index=True)
            put = first[free[first]]
            self.key[at[put]], self.value[at[put]] = keys[put], values[put]
            left = np.ones(len(keys), dtype=bool)
            left[put] = False
            keys, values, at = keys[left], values[left], (at[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Value of each key, -1 if none."""
        out = np.full(len(keys), -1, dtype=np.int64)
        open_, at = np.arange(len(keys)), self._slot(keys)
        while len(open_):
            found = self.key[at]
            hit = found == keys[open_]
            out[open_[hit]] = self.value[at[hit]]
            more = ~hit & (found != -1)
            open_, at = open_[more], (at[more] + 1) & ((1 << self.bits) - 1)
        return out


class PieceModel:
    """The vocabulary of a BPE model file with byte fallback, as arrays."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        norm, kinds = proto.normalizer_spec, proto.SentencePiece
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not norm.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models with identity normalisation, a leading space and byte fallback are supported")
        if any(p.type == kinds.USER_DEFINED for p in proto.pieces):
            raise ValueError("user-defined symbols are not supported")
        self.library = SentencePieceProcessor(model_file=path)
        self.size = len(proto.pieces)
        normal = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kinds.NORMAL}
        if any(SPACE in p.lstrip(SPACE) or (p[:2] == SPACE * 2 and p.strip(SPACE)) for p in normal):
            raise ValueError("pieces that reach over a space are not supported")
        self.symbols = dict(normal)
        for p in normal:
            for c in p:
                self.symbols.setdefault(c, len(self.symbols) + self.size)
        self.byte_id = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kinds.BYTE}
        self.bytes_ids = [self.byte_id[f"<0x{b:02X}>"] for b in range(256)]
        self.breaks_at_newline = not any("\n" in p for p in normal)
        scores = np.array([p.score for p in proto.pieces], dtype=np.float32)
        rank_of = {s: r for r, s in enumerate(sorted({float(scores[i]) for i in normal.values()}, reverse=True))}
        self.rank = np.array([rank_of.get(float(s), 0) for s in scores], dtype=np.int64)
        self.base = self.size + len(self.symbols) + 0x110000
        keys, made = array("q"), array("q")
        for p, i in normal.items():
            for k in range(1, len(p)):
                left, right = self.symbols.get(p[:k]), self.symbols.get(p[k:])
                if left is not None and right is not None:
                    keys.append(left * self.base + right)
                    made.append(i)
        self.char_of = {i: c for c, i in self.symbols.items() if len(c) == 1}
        self.pair_table = LongTable(np.frombuffer(keys, dtype=np.int64), np.frombuffer(made, dtype=np.int64))
        inside = {(a, b) for p in normal for a, b in zip(p, p[1:])}
        inside = np.array([self.symbols[a] * self.base + self.symbols[b] for a, b in inside], dtype=np.int64)
        self.inside_table = LongTable(inside, np.ones(len(inside), dtype=np.int64))
        # characters: code point -> symbol, those without one above all symbols
        self.char_symbol = np.arange(0x110000, dtype=np.int64) + self.size + len(self.symbols)
        for s, i in self.symbols.items():
            if len(s) == 1:
                self.char_symbol[ord(s)] = i
        self.first_unknown = self.size + len(self.symbols)
        out = [self._written(p, kinds) for p in proto.pieces]
        self.out_len = np.array([len(b) for b in out], dtype=np.int64)
        self.out_start = np.concatenate([[0], np.cumsum(self.out_len)])[:-1]
        self.out_bytes = np.frombuffer(b"".join(out), dtype=np.uint8)

    @staticmethod
    def _written(p, kinds) -> bytes:
        if p.type == kinds.BYTE:
            return bytes([int(p.piece[3:5], 16)])
        return p.piece.replace(SPACE, " ").encode() if p.type == kinds.NORMAL else b""

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of the piece that each pair makes, -1 if none."""
        return self.pair_table.find(left * self.base + right)

    def ranks(self, made: np.ndarray) -> np.ndarray:
        return np.where(made >= 0, self.rank[made], _NONE)

    def adjoining(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether some piece holds the two characters side by side; where none does, no merge ever reaches across."""
        return self.inside_table.find(left * self.base + right) >= 0

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids, as the library decodes them."""
        parts = []
        for k in range(0, len(ids), SLICE):
            some = ids[k : k + SLICE]
            length = self.out_len[some]
            parts.append(self.out_bytes[_spread(self.out_start[some], length)].tobytes())
        raw = b"".join(parts)
        raw = raw[1:] if len(ids) and raw[:1] == b" " and self.out_len[ids[0]] and self.out_bytes[self.out_start[ids[0]]] == 32 else raw
        try:
            return raw.decode()
        except UnicodeDecodeError:  # ids that no text has
            return self.library.decode(ids.tolist())


@lru_cache(maxsize=2)
def load(path: str) -> PieceModel:
    return PieceModel(path)


def _spread(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Positions start[k], start[k] + 1, ... of all runs, one after the other."""
    total = int(length.sum())
    before = np.cumsum(length) - length
    return np.arange(total, dtype=np.int64) + np.repeat(start - before, length)


def merge_rounds(model: PieceModel, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols after all merges, and the segment that each belongs to, segment by segment.

    ``symbols`` holds the segments' symbols one after the other; segment k begins at ``starts[k]``.
    """
    n = len(symbols)
    segment = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
    done_symbols, done_segments = [], []
    made = np.full(n, -1, dtype=np.int64)
    inner = np.flatnonzero(segment[:-1] == segment[1:])
    made[inner] = model.merged(symbols[inner], symbols[inner + 1])
    rank = model.ranks(made)
    while len(symbols):
        starts = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
        size = np.diff(np.append(starts, len(symbols)))
        best = np.minimum.reduceat(rank, starts)
        open_ = best != _NONE
        if not open_.all():
            stays = np.repeat(open_, size)
            done_symbols.append(symbols[~stays])
            done_segments.append(segment[~stays])
            symbols, segment, made, rank = symbols[stays], segment[stays], made[stays], rank[stays]
            best, size = best[open_], size[open_]
        if not len(symbols):
            break
        at = np.flatnonzero(rank == np.repeat(best, size))
        if len(at) > len(best):
            at = _together(model, symbols, segment, made, rank, at)
        symbols[at] = made[at]
        keep = np.ones(len(symbols), dtype=bool)
        keep[at + 1] = False
        at = at - np.arange(len(at))  # one symbol has gone for each merge before
        symbols, segment, made, rank = symbols[keep], segment[keep], made[keep], rank[keep]
        k = np.concatenate([at, at[at > 0] - 1])  # the pairs that have changed: with the next symbol, and with the last
        inside = (k + 1 < len(symbols)) & (segment[np.minimum(k + 1, len(symbols) - 1)] == segment[k])
        made[k], rank[k] = -1, _NONE
        k = k[inside]
        made[k] = model.merged(symbols[k], symbols[k + 1])
        rank[k] = model.ranks(made[k])
    if not done_symbols:
        return symbols, segment
    symbols, segment = np.concatenate(done_symbols), np.concatenate(done_segments)
    order = np.argsort(segment, kind="stable")
    return symbols[order], segment[order]


def _together(model: PieceModel, symbols: np.ndarray, segment: np.ndarray, made: np.ndarray, rank: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which of the best pairs (at ``at``, all of their segment's best rank) merge in one round, in the library's order.

    Of pairs that overlap the leftmost merges, then every second one. A merge that makes a pair as good as itself or
    better is the last of its segment in this round, since that pair comes before what lies to the right.
    """
    follows = np.concatenate([[False], at[1:] == at[:-1] + 1])
    begin = np.flatnonzero(~follows)
    index = np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))
    at = at[index % 2 == 0]
    new, own, worst = made[at], segment[at], rank[at]
    left, right = np.maximum(at - 1, 0), np.minimum(at + 2, len(symbols) - 1)
    before = symbols[left]
    joined = np.flatnonzero(np.concatenate([[False], at[1:] == at[:-1] + 2]))  # the symbol before is a merge's result
    before[joined] = new[joined - 1]
    first = model.ranks(np.where((at > 0) & (segment[left] == own), model.merged(before, new), -1))
    second = model.ranks(np.where((at + 2 < len(symbols)) & (segment[right] == own), model.merged(new, symbols[right]), -1))
    last = (first <= worst) | (second <= worst)
    if last.any():
        begin = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        cut = np.minimum.reduceat(np.where(last, np.arange(len(at)), len(at)), begin)
        at = at[np.arange(len(at)) <= np.repeat(cut, np.diff(np.append(begin, len(at))))]
    return at


class Encoder:
    """Encodes texts; remembers the ids of up to ``REMEMBERED`` segments."""

    _segments = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")

    def __init__(self, model: PieceModel, remembered: int = REMEMBERED):
        self.model, self.remembered = model, remembered
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.start = np.zeros(1 << 16, dtype=np.int64)
        self.length = np.zeros(1 << 16, dtype=np.int64)
        self.flat = np.zeros(1 << 18, dtype=np.int32)
        self.used = 0

    def cut(self, text: str) -> list[str]:
        """Segments of a text. One that a NUL leads has no space before it; any other has one that is left out."""
        if not text:
            return []
        if SPACE in text or "  " in text or "\0" in text or text[0] == " " or text[-1] == " ":
            return ["\0" + s for s in self._segments.findall(SPACE + text.replace(" ", SPACE))]
        if self.model.breaks_at_newline:
            text = text.replace("\n", " \0\n")
        return text.split(" ")

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the number of ids of each text."""
        segments: list[str] = []
        counts = np.zeros(len(texts), dtype=np.int64)
        for k, text in enumerate(texts):
            cut = self.cut(text)
            counts[k] = len(cut)
            segments += cut
        parts, lengths = [], []
        for k in range(0, len(segments), SLICE):
            flat, length = self._encode_segments(segments[k : k + SLICE])
            parts.append(flat)
            lengths.append(length)
        if not parts:
            return np.zeros(0, dtype=np.int32), counts
        total = np.concatenate([[0], np.cumsum(np.concatenate(lengths))])
        ends = np.concatenate([[0], np.cumsum(counts)])
        return np.concatenate(parts), np.diff(total[ends])

    def _encode_segments(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        at = np.fromiter(map(self.known.get, segments, repeat(-1)), dtype=np.int64, count=len(segments))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            if len(self.known) > self.remembered:
                self._forget()
                missing = np.arange(len(segments))
            known = self.known
            new = [s for s in dict.fromkeys([segments[k] for k in missing]) if s not in known]
            first = len(known)
            known.update(zip(new, range(first, first + len(new))))
            self._learn(new, first)
            at[missing] = np.fromiter((known[segments[k]] for k in missing), dtype=np.int64, count=len(missing))
        length = self.length[at]
        return self.flat[_spread(self.start[at], length)], length

    def _learn(self, new: list[str], first: int) -> None:
        written = [s[1:] if s[:1] == "\0" else SPACE + s for s in new]
        chars = np.frombuffer("".join(written).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        size = np.fromiter(map(len, written), dtype=np.int64, count=len(written))
        begin = np.cumsum(size) - size
        model = self.model
        symbols = model.char_symbol[chars]
        parts = [self._merged(symbols[begin[a] : begin[b - 1] + size[b - 1]], size[a:b], a) for a, b in self._runs(begin, size)]
        s, g = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        unknown = np.flatnonzero(s >= model.size)
        if len(unknown):  # characters without a piece become their bytes
            spelt = [self._spell(v) for v in s[unknown].tolist()]
            wide = np.ones(len(s), dtype=np.int64)
            wide[unknown] = list(map(len, spelt))
            first_of = np.cumsum(wide) - wide
            s, g = np.repeat(s, wide), np.repeat(g, wide)
            s[_spread(first_of[unknown], wide[unknown])] = np.concatenate(spelt)
        length = np.bincount(g, minlength=len(new))
        while first + len(new) > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        while self.used + len(s) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.start[first : first + len(new)] = self.used + np.cumsum(length) - length
        self.length[first : first + len(new)] = length
        self.flat[self.used : self.used + len(s)] = s
        self.used += len(s)

    @staticmethod
    def _runs(begin: np.ndarray, size: np.ndarray) -> Iterator[tuple[int, int]]:
        """Runs of segments of about ``TOGETHER`` symbols, so that what the rounds hold stays small."""
        a, ends = 0, begin + size
        while a < len(size):
            b = max(a + 1, int(np.searchsorted(ends, begin[a] + TOGETHER, side="right")))
            yield a, b
            a = b

    def _merged(self, symbols: np.ndarray, size: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of a run of segments after all merges, and the number of each one's segment, from ``first`` on."""
        spans = np.zeros(len(symbols), dtype=bool)
        spans[(np.cumsum(size) - size)[size > 0]] = True
        spans[1:] |= ~self.model.adjoining(symbols[:-1], symbols[1:])
        spans = np.flatnonzero(spans)
        s, g = merge_rounds(self.model, symbols, spans)
        return s, first + np.repeat(np.arange(len(size)), size)[spans][g]

    def _spell(self, symbol: int) -> list[int]:
        model = self.model
        char = model.char_of[symbol] if symbol < model.first_unknown else chr(symbol - model.first_unknown)
        return [model.bytes_ids[b] for b in char.encode()]


def text_slices(batch: pa.RecordBatch, column: str, chars: int = 500_000) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of a batch with about ``chars`` bytes of text, one row at least, and their texts with '' for null."""
    whole = batch.column(column)
    size = np.cumsum(pc.fill_null(pc.binary_length(whole), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < len(whole):
        end = max(begin + 1, int(np.searchsorted(size, (size[begin - 1] if begin else 0) + chars, side="right")))
        yield batch.slice(begin, end - begin), [t or "" for t in whole.slice(begin, end - begin).to_pylist()]
        begin = end


def encoded_slices(batches: Iterator[pa.RecordBatch], path: str, column: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of record batches with all their ids and the number of ids of each row."""
    encoder = Encoder(load(path))
    for batch in batches:
        for part, texts in text_slices(batch, column):
            yield part, *encoder.encode(texts)


def encode_documents(docs: DataFrame, path: str, column: str = "text", decode: bool = False) -> DataFrame:
    """``docs`` with ``ids`` (array of int) and, on request, ``decoded``: the text that the ids give back."""
    rows, places, names, at = apart(docs, (column,), ("ids", "decoded"))
    schema = T.StructType([*rows.select(*places).schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)] + [T.StructField("decoded", T.StringType(), False)] * decode)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for part, flat, counts in encoded_slices(batches, path, at[column]):
            offsets = np.concatenate([[0], np.cumsum(counts)])
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
            arrays = [part.column(n) for n in places] + [ids]
            if decode:
                arrays.append(pa.array([model.decode(flat[a:b]) for a, b in zip(offsets[:-1], offsets[1:])], pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, [*places, "ids"] + ["decoded"] * decode)

    return rows.mapInArrow(run, schema).toDF(*names, "ids", *["decoded"] * decode)
