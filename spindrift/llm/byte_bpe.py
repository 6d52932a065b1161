"""Byte-level BPE as a streaming transducer, and decoding as an incremental machine from bytes to text.

BPE merges the best pair of a whole piece first, so what comes later may change what has been read. How far back it can
reach follows from the merge list (``sufficient_lookahead``): appending to a piece changes a settled token only through a
chain of merges, each of a later rule than the one before and each across the boundary that the last one left. Tokens that
end further from the end of what was read than the longest chain are final. The transducer holds a window of bytes, emits
its final tokens, and goes on from where they end, so its memory does not grow with the piece.

A text is cut where runs of white space begin, which is where pieces never cross; each distinct chunk of a batch goes
through the pre-tokenizer's pattern and the transducer once, and a worker remembers frequent chunks within a bound.

Defined results: a null text counts as empty and has no ids; texts are encoded whole, whatever their length; the special
tokens of the tokenizer's file are found in texts, as its library finds them; repeated rows count each; null doc_ids are
kept; an empty table gives an empty result; extra columns, whatever their names, are ignored. Ties in BPE go to the
leftmost pair. A tokenizer file of another make is refused with ValueError.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from .common import chosen
from .piece_bpe import LongTable, merge_rounds
from .word_table import REMEMBERED, WordTable, byte_letters, spread, text_slices

#: The byte-level pre-tokenizer's pattern: a fixed value of that format.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces of up to so many symbols merge by scanning, longer ones with a heap.
SCANNED = 40
#: Ids that a decoder takes at a time.
BLOCK = 1 << 16
#: Bytes of short pieces that merge side by side.
TOGETHER = 1 << 20
_NONE = np.iinfo(np.int64).max


def sufficient_lookahead(pairs: list[tuple[int, int]], product: list[int], length: dict[int, int]) -> int:
    """Bytes after which a token can no longer change, from the merge list in its order.

    A rule (u, v) moves the boundary between what is settled and what is not from the end of u to its beginning. The next
    rule of a chain comes later in the list, ends with its own u at that boundary, and its v must begin there: with the
    last rule's u, or with a token that was merged from that u onwards. The longest chain, in bytes, is the answer.
    """
    left = {new: u for (u, _), new in zip(pairs, product)}
    longest: dict[int, int] = {}  # by token: chains of later rules whose v begins with it
    most = 0
    for u, v in reversed(pairs):
        chain = length[u] + longest.get(u, 0)
        most = max(most, chain)
        begins: int | None = v
        while begins is not None:
            longest[begins] = max(longest.get(begins, 0), chain)
            begins = left.get(begins)
    return most


class MergeList:
    """The merges of a byte-level tokenizers file."""

    def __init__(self, spec: dict):
        pre, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
        plain = (spec.get("normalizer"), pre.get("type"), pre.get("add_prefix_space"), pre.get("use_regex"), (spec.get("decoder") or {}).get("type"))
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        flags = [t for t in spec.get("added_tokens") or [] if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]]
        if plain != (None, "ByteLevel", False, True, "ByteLevel") or model.get("type") != "BPE" or odd or flags:
            raise ValueError("not a plain byte-level BPE file")
        vocab, letters = model["vocab"], byte_letters()
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.first = [vocab[letters[b]] for b in range(256)]
        self.first_array = np.array(self.first, dtype=np.int64)
        self.pairs = [(vocab[a], vocab[b]) for a, b in pairs]
        self.product = [vocab[a + b] for a, b in pairs]
        self.order = {p: k for k, p in enumerate(self.pairs)}
        known = set(self.first)
        for (a, b), new in zip(self.pairs, self.product):
            if a not in known or b not in known or new in known:
                raise ValueError("a merge of tokens that no earlier merge makes, or a token made twice")
            known.add(new)
        byte_of = {c: b for b, c in letters.items()}
        self.bytes_of = [b""] * (1 + max([*vocab.values(), *self.added.values()]))
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(byte_of[c] for c in token)
        for token, i in self.added.items():
            self.bytes_of[i] = token.encode()
        self.length = {i: len(b) for i, b in enumerate(self.bytes_of)}
        self.size = len(self.bytes_of)
        self.table = LongTable(np.array([a * self.size + b for a, b in self.pairs], dtype=np.int64), np.array(self.product, dtype=np.int64))
        self.rank_of = np.full(self.size + 1, _NONE, dtype=np.int64)  # by token, and by -1 for no token
        self.rank_of[self.product] = np.arange(len(self.product))
        self.lookahead = sufficient_lookahead(self.pairs, self.product, self.length)
        self.window = 4 * (self.lookahead + max(self.length.values()))

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What pairs merge to; -1 where they don't."""
        return self.table.find(left * self.size + right)

    def ranks(self, made: np.ndarray) -> np.ndarray:
        return self.rank_of[made]

    def merge_side_by_side(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole runs of bytes, none of them empty, one after the other; and the number of each one's ids."""
        flat, counts, k = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        ends = np.cumsum([len(r) for r in runs])
        while k < len(runs):
            end = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + TOGETHER, side="right")))
            length = np.diff(ends[k:end], prepend=ends[k - 1] if k else 0)
            symbols, run = merge_rounds(self, self.first_array[np.frombuffer(b"".join(runs[k:end]), np.uint8)], np.cumsum(length) - length)
            flat.append(symbols)
            counts.append(np.bincount(run, minlength=end - k))
            k = end
        return np.concatenate(flat), np.concatenate(counts)

    def merge(self, data: bytes) -> list[int]:
        """Ids of a whole run of bytes: the best pair merges first, the leftmost of equal ones."""
        symbols = [self.first[b] for b in data]
        if len(symbols) > SCANNED:
            return self._by_heap(symbols)
        rank, product = self.order.get, self.product
        ranks = list(map(rank, zip(symbols, symbols[1:]), repeat(_NONE)))
        while ranks and (best := min(ranks)) != _NONE:
            at = ranks.index(best)
            symbols[at] = new = product[best]
            del symbols[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank((symbols[at - 1], new), _NONE)
            if at < len(ranks):
                ranks[at] = rank((new, symbols[at + 1]), _NONE)
        return symbols

    def _by_heap(self, symbols: list[int]) -> list[int]:
        n, rank = len(symbols), self.order.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, k) for k, p in enumerate(zip(symbols, symbols[1:])) if (r := rank(p, _NONE)) != _NONE]
        heapq.heapify(heap)
        while heap:
            r, k = heapq.heappop(heap)
            nxt = after[k] if symbols[k] >= 0 else n
            if nxt >= n or rank((symbols[k], symbols[nxt]), _NONE) != r:
                continue  # one of the pair has been merged since
            symbols[k], symbols[nxt] = self.product[r], -1
            after[k] = far = after[nxt]
            if far < n:
                before[far] = k
                if (r := rank((symbols[k], symbols[far]), _NONE)) != _NONE:
                    heapq.heappush(heap, (r, k))
            if (near := before[k]) >= 0 and (r := rank((symbols[near], symbols[k]), _NONE)) != _NONE:
                heapq.heappush(heap, (r, near))
        return [s for s in symbols if s >= 0]


class Transducer:
    """Ids of one piece whose bytes come bit by bit; holds a window of them at most."""

    def __init__(self, merges: MergeList):
        self.merges, self.held = merges, bytearray()

    def feed(self, data: bytes) -> list[int]:
        """Ids that are final after these bytes."""
        if len(self.held) + len(data) < self.merges.window:
            self.held += data
            return []
        out: list[int] = []
        window, most = self.merges.window, self.merges.window - self.merges.lookahead
        at = 0
        while at < len(data):
            taken = data[at : at + window - len(self.held)]
            self.held += taken
            at += len(taken)
            if len(self.held) < window:
                break
            end = 0
            for i in self.merges.merge(self.held):
                if end + self.merges.length[i] > most:
                    break
                end += self.merges.length[i]
                out.append(i)
            del self.held[:end]
        return out

    def finish(self) -> list[int]:
        """The ids that were still open when the piece ended."""
        out = self.merges.merge(self.held)
        self.held.clear()
        return out


def transduce(merges: MergeList, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of pieces, none of them empty, one after the other, and the number of each one's ids.

    Pieces that end within a window never have to wait for more bytes; their windows merge side by side.
    """
    long = {k: [i for some in _streamed(merges, p) for i in some] for k, p in enumerate(pieces) if len(p) >= merges.window}
    flat, counts = merges.merge_side_by_side([p for p in pieces if len(p) < merges.window])
    if not long:
        return flat, counts
    whole = np.zeros(len(pieces), dtype=np.int64)
    short = np.ones(len(pieces), dtype=bool)
    short[list(long)] = False
    whole[short], whole[~short] = counts, [len(long[k]) for k in sorted(long)]
    starts = np.cumsum(whole) - whole
    out = np.empty(int(whole.sum()), dtype=np.int64)
    out[spread(starts[short], counts)] = flat
    out[spread(starts[~short], whole[~short])] = [i for k in sorted(long) for i in long[k]]
    return out, whole


def _streamed(merges: MergeList, piece: bytes) -> Iterator[list[int]]:
    transducer = Transducer(merges)
    for k in range(0, len(piece), BLOCK):
        yield transducer.feed(piece[k : k + BLOCK])
    yield transducer.finish()


class TextDecoder:
    """Text of ids that come bit by bit; between calls it holds the bytes of one unfinished character at most.

    Bytes that are no UTF-8 become U+FFFD, one for each longest part that could have begun a character.
    """

    def __init__(self, encoder: ByteEncoder):
        self.encoder, self.machine = encoder, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: np.ndarray) -> str:
        return self.machine.decode(self.encoder.bytes_of(ids))

    def finish(self) -> str:
        return self.machine.decode(b"", final=True)


#: Which bytes are white space in ASCII, for the pattern.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _other_space(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a character of white space beyond ASCII ends right before each place."""
    c, b, a = (data[np.maximum(at - k, 0)] for k in (1, 2, 3))
    two = (b == 0xC2) & ((c == 0x85) | (c == 0xA0))
    general = (a == 0xE2) & (b == 0x80) & (((c >= 0x80) & (c <= 0x8A)) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
    single = ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE2) & (b == 0x81) & (c == 0x9F)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
    return two | general | single


def cut_chunks(texts: pa.StringArray) -> tuple[pa.BinaryArray, np.ndarray]:
    """Chunks of all texts, none of them null, and the number of each text's chunks.

    A chunk begins with its text, or with a run of white space; no copy of the bytes is made.
    """
    _, ends, body = texts.buffers()
    ends = np.frombuffer(ends, dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, np.uint8)
    data, ends = data[ends[0] : ends[-1]], ends - ends[0]
    space = _SPACE[data]
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    at = np.flatnonzero(begins)
    begins[at[_other_space(data, at)]] = False
    begins[ends[:-1][ends[:-1] < ends[1:]]] = True
    at = np.flatnonzero(begins)
    counts = np.diff(np.searchsorted(at, ends))
    offsets = np.append(at, len(data)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)]), counts


class ByteEncoder(WordTable):
    """Ids of texts by a byte-level tokenizers file, and the bytes of ids."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        super().__init__(b"", remembered)
        with open(path, encoding="utf-8") as f:
            self.merges = MergeList(json.load(f))
        self.pieces = regex.compile(PIECES).findall
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.merges.added, key=len, reverse=True))) + ")") if self.merges.added else None
        parts = self.merges.bytes_of
        self.byte_length = np.array([len(b) for b in parts], dtype=np.int64)
        self.byte_start = np.cumsum(self.byte_length) - self.byte_length
        self.byte_flat = np.frombuffer(b"".join(parts), dtype=np.uint8)

    def bytes_of(self, ids: np.ndarray) -> bytes:
        return self.byte_flat[spread(self.byte_start[ids], self.byte_length[ids])].tobytes()

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the number of ids of each text; null counts as empty."""
        texts = pc.fill_null(texts, "")
        if self.special is None:
            return self._plain(texts)
        held = np.zeros(len(texts), dtype=bool)
        for token in self.merges.added:
            held |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        if not held.any():
            return self._plain(texts)
        # what stands between special tokens is a text of its own, each special token one id after it
        parts, owner, closes = [], [], []
        for k, (text, has) in enumerate(zip(texts.to_pylist(), held.tolist())):
            cut = [*(self.special.split(text) if has else [text]), ""]
            parts += cut[::2]
            closes += [self.merges.added.get(c, -1) for c in cut[1::2]]
            owner += [k] * (len(cut) // 2)
        flat, counts = self._plain(pa.array(parts, pa.string()))
        closes, owner = np.array(closes), np.array(owner)
        whole = counts + (closes >= 0)
        out = np.empty(int(whole.sum()), dtype=np.uint32)
        starts = np.cumsum(whole) - whole
        out[spread(starts, counts)] = flat
        out[(starts + counts)[closes >= 0]] = closes[closes >= 0]
        return out, np.bincount(owner, weights=whole, minlength=len(texts)).astype(np.int64)

    def _plain(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        chunks, counts = cut_chunks(texts)
        chunks = chunks.dictionary_encode()
        rows = self.rows(chunks.dictionary.to_pylist())
        at = chunks.indices.to_numpy(zero_copy_only=False)
        self.hits[rows] += np.bincount(at, minlength=len(rows))
        at = rows[at]
        length = self.length[at]
        flat = self.flat[spread(self.start[at], length)]
        total = np.concatenate([[0], np.cumsum(length)])
        return flat, np.diff(total[np.concatenate([[0], np.cumsum(counts)])])

    def learn(self, new: list[bytes]) -> None:
        known = self.known
        # letters with a space or none before them are one piece
        parts = [[chunk] if chunk.removeprefix(b" ").isalpha() else [p.encode() for p in self.pieces(chunk.decode())] for chunk in new]
        # a piece is a chunk whose only piece is itself
        ask = [p for p in dict.fromkeys(p for some in parts for p in some) if p not in known]
        self.append(ask, *transduce(self.merges, ask))
        composed = [(chunk, some) for chunk, some in zip(new, parts) if chunk not in known]
        if composed:
            size = np.array([len(some) for _, some in composed], dtype=np.int64)
            rows = np.array([known[p] for _, some in composed for p in some], dtype=np.int64)
            length = self.length[rows]
            self.append([chunk for chunk, _ in composed], self.flat[spread(self.start[rows], length)], np.add.reduceat(length, np.cumsum(size) - size))


@lru_cache(maxsize=2)
def byte_encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)


def encoded_slices(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of batches with a column ``text``: the rows, their ids one after the other, and how many each row has."""
    encoder = byte_encoder(path)
    for batch in batches:
        for part, texts in text_slices(batch):
            yield part, *encoder.encode(texts)


def decoded_blocks(encoder: ByteEncoder, ids: np.ndarray) -> Iterator[str]:
    """The text of ids, block by block."""
    machine = TextDecoder(encoder)
    for k in range(0, len(ids), BLOCK):
        yield machine.feed(ids[k : k + BLOCK])
    yield machine.finish()


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (array<int>) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, flat, counts in encoded_slices(batches, path):
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.ListArray.from_arrays(offsets, pa.array(flat.astype(np.int32)))], ["doc_id", "ids"])

    return chosen(docs, "doc_id", "text").mapInArrow(run, f"doc_id {docs.select('doc_id').dtypes[0][1]}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of every row of ids; null ids count as none, an id outside of the vocabulary is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(path)
        for batch in batches:
            texts = ["".join(decoded_blocks(encoder, np.array(ids or [], dtype=np.int64))) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return chosen(encoded, "doc_id", "ids").mapInArrow(run, f"doc_id {encoded.select('doc_id').dtypes[0][1]}, text string")
