"""Token ids in shard files with a minimal perfect hash index from document keys to shard offsets.

Documents are ranged by doc_id, so that shard k's keys all come before shard k + 1's, and sorted within a shard. A
shard is two files: raw little-endian ids (16 bits where the vocabulary allows, else 32), and an index. The index holds
the documents' offsets into the payload and a minimal perfect hash of the keys: levels of bit arrays in which a key is
settled at the first level where no other key shares its bit; a key's number is the rank of that bit. By that number a
32-bit fingerprint and the key's first document are stored, so a lookup takes constant time and a foreign key is
refused except for one in 2**32.

A task writes under names of its own and reports them in a manifest row when they are complete; readers follow the
manifest alone, so what a lost or repeated task has left behind is never read.

Defined results: a null text gives the end id alone; null doc_ids come first and are kept but have no key; equal doc_ids
are ordered by a hash of the text and the key finds the first of them in its shard; texts of any length are encoded
whole; an empty table gives an empty manifest; extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import chosen, materialize, open_store, shared_dir
from .word_table import REMEMBERED, WordTable, byte_letters, spread, text_slices

MAGIC = b"SPDTOKN1"
#: Bits of a level for each key that is still open.
GAMMA = 1.6
MANIFEST = "shard int, path string, first_id long, last_id long, n_docs long, n_tokens long"


#: Shape of a tokenizers file whose words can be looked up one by one, in lower case: fixed values of that format.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _by_words(spec: dict) -> bool:
    """Whether a tokenizers file lowers letters, drops white space, cuts words by ``_WORDS`` and joins bytes by BPE."""
    normal, pre, model = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    split, *rest = [*(pre.get("pretokenizers") or []), {}]
    return (
        normal.get("normalizers") == _NORMALIZERS
        and (split.get("pattern"), split.get("behavior"), split.get("invert")) == ({"Regex": _WORDS}, "Removed", True)
        and [(x.get("type"), x.get("add_prefix_space"), x.get("use_regex")) for x in rest[:-1]] == [("ByteLevel", False, False)]
        and (model.get("type"), model.get("dropout"), model.get("end_of_word_suffix")) == ("BPE", None, "</w>")
        and not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] or len(t["content"].split()) != 1 for t in spec.get("added_tokens") or [])
    )


class WordEncoder(WordTable):
    """Ids of texts by a tokenizers file.

    Where the file's own specification says that words are independent (``_by_words``), each distinct word is cut into
    the pieces of that specification and each distinct piece goes through the library's BPE once; what is outside of
    Latin letters, digits and marks, or holds a special token, goes through the library as it is. For any other file
    every text goes through the library whole.

    Up to ``remembered`` words and pieces are kept; beyond that the more frequent half stays.
    """

    #: Characters whose normal form, case and class are settled, but for white space.
    _SETTLED = re.compile("[!-~\u00a1-\u012f\u0131-\u017f]+")

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        super().__init__("", remembered)
        self.library = Tokenizer.from_file(path)
        self.size = self.library.get_vocab_size()
        self.by_words = _by_words(spec)
        if self.by_words:
            self.special = [t["content"] for t in spec.get("added_tokens") or []]
            self.holds_special = re.compile("|".join(map(re.escape, self.special)) or "(?!)").search
            self.model = Tokenizer.from_file(path)
            self.model.normalizer = self.model.pre_tokenizer = None
            self.ends = np.zeros(1 + max(self.library.get_vocab().values()), dtype=bool)
            self.ends[[i for w, i in spec["model"]["vocab"].items() if w.endswith("</w>")]] = True
            settled = [chr(c) for c in range(0x21, 0x180)]
            of = lambda kind: "".join(re.escape(c) for c in settled if unicodedata.category(c)[0] == kind)
            self.pieces = re.compile(_WORDS.replace(r"\p{L}", of("L")).replace(r"\p{N}", of("N"))).findall
            self.letters = byte_letters()

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the number of ids of each text; null counts as empty."""
        texts = pc.fill_null(texts, "")
        if not self.by_words:
            return self._library(texts.to_pylist())
        lowered = pc.ascii_lower(texts)
        for token in self.special:  # special tokens are told by case
            held = pc.match_substring(texts, token, ignore_case=True)
            lowered = pc.if_else(held, texts, lowered) if pc.any(held).as_py() else lowered
        split = pc.ascii_split_whitespace(lowered)
        words = split.flatten().dictionary_encode()
        rows = self.rows(words.dictionary.to_pylist())
        at = words.indices.to_numpy(zero_copy_only=False)
        self.hits[rows] += np.bincount(at, minlength=len(rows))
        at = rows[at]
        length = self.length[at]
        flat = self.flat[spread(self.start[at], length)]
        total = np.concatenate([[0], np.cumsum(length)])
        counts = pc.list_value_length(split).to_numpy(zero_copy_only=False)
        return flat, np.diff(total[np.concatenate([[0], np.cumsum(counts)])])

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts from the library, and the number of each."""
        each = [np.array(e.ids, dtype=np.uint32) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        return (np.concatenate(each) if each else np.zeros(0, dtype=np.uint32)), np.array([len(x) for x in each], dtype=np.int64)

    def learn(self, new: list[str]) -> None:
        known, settled, find, special = self.known, self._SETTLED.fullmatch, self.pieces, self.holds_special
        whole, cut, parts = [], [], []
        for word in new:
            if settled(word) and not special(word):
                cut.append(word)
                parts.append(find(word.lower()))
            else:
                whole.append(word)
        # a piece is a word whose only piece is itself
        ask = [p for p in dict.fromkeys([p for some in parts for p in some]) if p not in known]
        self.append(ask, *self._model(ask))
        composed = [(w, p) for w, p in zip(cut, parts) if w not in known]
        if composed:
            size = np.array([len(p) for _, p in composed], dtype=np.int64)
            rows = np.array([known[x] for _, p in composed for x in p], dtype=np.int64)
            length = self.length[rows]
            self.append([w for w, _ in composed], self.flat[spread(self.start[rows], length)], np.add.reduceat(length, np.cumsum(size) - size))
        if whole:
            self.append(whole, *self._library(whole))

    def _model(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces from the library's BPE; an id with a word end closes each piece."""
        runs = [[p if p.isascii() else p.encode().decode("latin-1").translate(self.letters) for p in pieces[k : k + 2000]] for k in range(0, len(pieces), 2000)]
        found = [np.array(e.ids, dtype=np.uint32) for e in self.model.encode_batch_fast(runs, is_pretokenized=True, add_special_tokens=False)]
        flat = np.concatenate(found) if found else np.zeros(0, dtype=np.uint32)
        ends = np.flatnonzero(self.ends[flat])
        if len(ends) != len(pieces) or len(ends) and ends[-1] != len(flat) - 1:
            raise ValueError("the library's pieces do not end with word ends")
        return flat, np.diff(np.concatenate([[-1], ends]))


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 well-mixed bits of each key."""
    x = keys.astype(np.int64).view(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys: n keys, numbers 0 to n - 1."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # one bool array for each
        self.ranks, at = [], 0
        for bits in levels:
            rank = np.cumsum(bits) - bits + at
            self.ranks.append(rank)
            at += int(bits.sum())
        self.n = at

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels: list[np.ndarray] = []
        while len(keys):
            size = max(8, int(GAMMA * len(keys)))
            at = (_mix(keys, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            keys = keys[~alone[at]]
        return cls(levels)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """Each key's number; -1 if no level settles it, and any number for some foreign keys."""
        out = np.full(len(keys), -1, dtype=np.int64)
        open_ = np.arange(len(keys))
        for level, (bits, rank) in enumerate(zip(self.levels, self.ranks)):
            at = (_mix(keys[open_], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[open_[hit]] = rank[at[hit]]
            open_ = open_[~hit]
        return out


class ShardIndex:
    """What a shard's index file says."""

    def __init__(self, width: int, ids: np.ndarray, nulls: int, offsets: np.ndarray):
        self.width, self.ids, self.nulls, self.offsets = width, ids, nulls, offsets
        keys, first, copies = np.unique(ids[nulls:], return_index=True, return_counts=True)
        self.hash = PerfectHash.build(keys)
        at = self.hash.numbers(keys)
        self.print_ = np.zeros(len(keys), dtype=np.uint32)
        self.first = np.zeros(len(keys), dtype=np.int64)
        self.copies = np.zeros(len(keys), dtype=np.int64)
        self.print_[at] = self._fingerprint(keys)
        self.first[at], self.copies[at] = first + nulls, copies

    @staticmethod
    def _fingerprint(keys: np.ndarray) -> np.ndarray:
        return (_mix(keys, 1_000_003) & np.uint64(0xFFFFFFFF)).astype(np.uint32)

    def lookup(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First document and number of documents of each key; -1 and 0 for a key that is not there."""
        at = self.hash.numbers(keys)
        known = at >= 0
        known[known] = self.print_[at[known]] == self._fingerprint(keys[known])
        first, copies = np.full(len(keys), -1, dtype=np.int64), np.zeros(len(keys), dtype=np.int64)
        first[known], copies[known] = self.first[at[known]], self.copies[at[known]]
        return first, copies

    def to_bytes(self) -> bytes:
        head = struct.pack("<8sIIQQQ", MAGIC, self.width, len(self.hash.levels), len(self.ids), self.nulls, len(self.first))
        sizes = np.array([len(b) for b in self.hash.levels], dtype="<u8").tobytes()
        bits = b"".join(np.packbits(b).tobytes() for b in self.hash.levels)
        arrays = [self.ids.astype("<i8"), self.offsets.astype("<u8"), self.print_.astype("<u4"), self.first.astype("<u8"), self.copies.astype("<u8")]
        body = sizes + bits + b"".join(a.tobytes() for a in arrays)
        return head + body + struct.pack("<I", zlib.crc32(head + body))

    @classmethod
    def from_bytes(cls, raw: bytes) -> ShardIndex:
        magic, width, n_levels, n, nulls, n_keys = struct.unpack_from("<8sIIQQQ", raw)
        if magic != MAGIC or zlib.crc32(raw[:-4]) != struct.unpack("<I", raw[-4:])[0]:
            raise ValueError("not an intact index file")
        at = struct.calcsize("<8sIIQQQ")
        sizes = np.frombuffer(raw, "<u8", n_levels, at)
        at += 8 * n_levels
        levels = []
        for size in sizes.tolist():
            levels.append(np.unpackbits(np.frombuffer(raw, np.uint8, (size + 7) // 8, at), count=size).astype(bool))
            at += (size + 7) // 8
        out = object.__new__(cls)
        out.width, out.nulls, out.hash = width, nulls, PerfectHash(levels)
        for name, kind, count in (("ids", "<i8", n), ("offsets", "<u8", n + 1), ("print_", "<u4", n_keys), ("first", "<u8", n_keys), ("copies", "<u8", n_keys)):
            array = np.frombuffer(raw, kind, count, at)
            at += array.nbytes
            setattr(out, name, array.astype(np.int64) if kind == "<u8" else array)
        return out


def write_shards(docs: DataFrame, tokenizer: str, end_id: int, out: str | None = None) -> DataFrame:
    """Encode (doc_id, text) into shard files under ``out``; the written manifest, one row per shard."""
    spark = docs.sparkSession
    folder = out or shared_dir(spark, "token-shards")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = chosen(docs, "doc_id", "text")
    rows = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words = encoder(tokenizer)
        width = 2 if max(words.size, end_id + 1) <= 1 << 16 else 4
        shard, ids, nulls, counts = TaskContext.get().partitionId(), [], 0, []
        store, base = open_store(folder)
        path = f"{base}/shard-{shard:06d}-{uuid.uuid4().hex}"
        stream = None
        for batch in batches:
            for part, texts in text_slices(batch):
                if stream is None:
                    stream = store.open_output_stream(path + ".bin")
                flat, n = words.encode(texts)
                n = n + 1
                full = np.empty(int(n.sum()), dtype=f"<u{width}")
                ends = np.cumsum(n) - 1
                body = np.ones(len(full), dtype=bool)
                body[ends] = False
                full[body], full[ends] = flat, end_id
                stream.write(full.tobytes())
                column = part.column("doc_id")
                nulls += column.null_count
                ids.append(column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
                counts.append(n)
        if stream is None:
            return
        stream.close()
        ids, offsets = np.concatenate(ids), np.concatenate([[0], np.cumsum(np.concatenate(counts))])
        with store.open_output_stream(path + ".idx") as f:
            f.write(ShardIndex(width, ids, nulls, offsets).to_bytes())
        keys = ids[nulls:]
        row = {"shard": shard, "path": path, "first_id": int(keys[0]) if len(keys) else None, "last_id": int(keys[-1]) if len(keys) else None, "n_docs": len(ids), "n_tokens": int(offsets[-1])}
        schema = pa.schema([("shard", pa.int32()), ("path", pa.string()), ("first_id", pa.int64()), ("last_id", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])
        yield pa.RecordBatch.from_pylist([row], schema=schema)

    return materialize(rows.mapInArrow(run, MANIFEST).withColumn("folder", F.lit(folder)), "token-manifest")


def read_index(folder: str, path: str) -> tuple[ShardIndex, object]:
    """A shard's index and its open payload."""
    store, _ = open_store(folder)
    with store.open_input_stream(path + ".idx") as f:
        index = ShardIndex.from_bytes(f.read())
    return index, store.open_input_file(path + ".bin")


def read_document(index: ShardIndex, payload, position: int) -> np.ndarray:
    """Ids of one document by its position in the shard."""
    return next(read_run(index, payload, np.array([position])))


def read_run(index: ShardIndex, payload, positions: np.ndarray, size: int = 1 << 22) -> Iterator[np.ndarray]:
    """Ids of documents by their ascending positions; neighbours are read together, up to ``size`` ids at a time."""
    first, last = index.offsets[positions], index.offsets[positions + 1]
    breaks = np.flatnonzero(last[:-1] != first[1:]) + 1
    for some in np.split(np.arange(len(positions)), breaks):
        at = 0
        while at < len(some):
            a = int(first[some[at]])
            end = max(at + 1, int(np.searchsorted(last[some], a + size, side="right")))
            b = int(last[some[end - 1]])
            ids = np.frombuffer(payload.read_at((b - a) * index.width, a * index.width), dtype=f"<u{index.width}")
            if len(ids) != b - a:
                raise ValueError("a payload that ends too early")
            for k in some[at:end].tolist():
                yield ids[int(first[k]) - a : int(last[k]) - a]
            at = end


def read_shards(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, each found by its key in its shard's index."""
    # one row per shard file
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = manifest.withColumn("before", before)
    n = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                index, payload = read_index(row["folder"], row["path"])
                keys = np.unique(index.ids[index.nulls :])
                first, copies = index.lookup(keys)
                if (first < 0).any():
                    raise ValueError(f"{row['path']}: keys that its index does not find")
                at = np.concatenate([np.arange(index.nulls), spread(first, copies)]).astype(np.int64)
                size = np.diff(index.offsets)[at]
                crc = np.fromiter((zlib.crc32(ids.astype("<u4").tobytes()) for ids in read_run(index, payload, at)), dtype=np.int64, count=len(at))
                ids = pa.array(np.concatenate([np.zeros(index.nulls, np.int64), np.repeat(keys, copies)]), mask=np.arange(len(at)) < index.nulls)
                yield pa.RecordBatch.from_arrays([ids, pa.array(index.offsets[at] + row["before"]), pa.array(size), pa.array(crc)], schema=schema)

    return shards.repartition(n, "shard").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
