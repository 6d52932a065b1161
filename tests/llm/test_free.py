"""Archives, the classifier, near-duplicates, tokenizers, token files and top-k on small tables, and the pipeline."""

import base64
import hashlib
import io
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F

from spindrift.llm import components, piece_bpe, rule_ensemble, simhash, token_files, top_k, warc

SF = "/root/testdata/sf0.001"


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# WARC


def archive(records):
    out = io.BytesIO()
    writer = warc.ArchiveWriter(out)
    for r in records:
        writer.add(r)
    out.close, raw = (lambda: None), out
    writer.close()
    return raw.getvalue()


def test_warc_round_trip(spark):
    rows = [(i, f"http://x/{i}", "same" if i % 3 == 0 else f"<p>{i}</p>" * i) for i in range(40)]
    rows += [(100, None, None), (101, "a b\nc", ""), (5000, "http://big", "z" * 3_000_000), (None, "http://n", "same"), (102, "u", "é ")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("first", F.lit(1)).withColumn("sha1", F.lit(2))
    got = warc.read_archives(warc.write_archives(pages)).collect()
    assert len(got) == len(rows)
    largest = {}
    for i, _, h in rows:
        largest[h or ""] = max(largest.get(h or "", -1), -1 if i is None else i)
    for r in got:
        html = next(h or "" for i, _, h in rows if i == r.page_id)
        body = html.encode()
        assert r.payload_bytes == len(body) and r.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
        top = largest[html]
        assert (r.record_type, r.refers_to) == (("response", None) if r.page_id == top else ("revisit", top))
        assert r.payload == (body if r.page_id == top else None)
    assert warc.read_archives(warc.write_archives(pages.filter("false"))).collect() == []


def test_warc_damage_is_found():
    records = [warc.record_bytes(i, f"http://x/{i}", b"payload %d" % i * 50, None, False) for i in range(300)]
    raw = archive(records)
    frames = list(warc.read_frames(io.BytesIO(raw)))
    assert frames == records and [warc.parse_record(f)["page_id"] for f in frames] == list(range(300))
    assert struct.unpack_from("<I", raw)[0] == warc.SKIPPABLE
    for bad in (raw[:-5], raw[4:], raw[:20], raw[:-300] + b"\0" * 300):
        with pytest.raises(warc.WarcError):
            list(warc.read_frames(io.BytesIO(bad)))
    one = records[7]
    for bad in (one[:-1], one.replace(b"WARC/1.1", b"WARC/9"), one.replace(b"payload 7", b"payload 8", 1), one.replace(b"WARC-Type: response\r\n", b""), one.replace(b"WARC-Date:", b"WARC Date:"), one + b"x"):
        with pytest.raises(warc.WarcError):
            warc.parse_record(bad)


def test_warc_frames_need_the_dictionary():
    raw = archive([warc.record_bytes(i, None, b"some shared text " * 20, None, False) for i in range(300)])
    size = struct.unpack_from("<I", raw, 4)[0]
    with pytest.raises(zstandard.ZstdError):
        zstandard.ZstdDecompressor().decompressobj().decompress(raw[8 + size :])


# classifier


def test_rule_ensemble_learns_and_compiles(spark):
    rng = np.random.default_rng(0)
    x = rng.random((3000, len(rule_ensemble.STATS)))
    y = ((x[:, 2] < 0.3) & (x[:, 5] > 0.2) | (x[:, 8] > 0.9)).astype(int)
    model = rule_ensemble.fit_ensemble(x, y)
    score = np.full(len(x), model.intercept)
    for rule, w in model.rules:
        score += w * rule.holds(x)
    assert ((score > 0) == y).mean() > 0.95 and len(model.rules) > 0
    df = spark.createDataFrame([tuple(map(float, r)) for r in x[:200]], ", ".join(f"{s} double" for s in rule_ensemble.STATS))
    got = [r[0] for r in df.select(model.column(F.struct(*rule_ensemble.STATS))).collect()]
    assert np.allclose(got, 1 / (1 + np.exp(-score[:200])))
    assert rule_ensemble.fit_ensemble(x[:50], np.ones(50)).rules == ()


def test_classifier_edges_and_accuracy(spark):
    docs, labels = documents(spark), spark.read.parquet(f"{SF}/labels.parquet")
    model = rule_ensemble.fit_quality(docs, labels.unionByName(spark.createDataFrame([(None, 1, 0), (1, None, 0)], labels.schema)))
    assert model == rule_ensemble.fit_quality(docs, labels)
    odd = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "w " * 200_000, "x"), (3, "w " * 200_000, "x")], "doc_id long, text string, score string")
    got = rule_ensemble.score_quality(odd, model).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got) and got[0].score == got[1].score
    scored = rule_ensemble.score_quality(docs, model).join(labels, "doc_id").select("quality", "score").toPandas()
    assert ((scored.score >= 0.3) == (scored.quality == 1)).mean() > 0.93
    assert rule_ensemble.score_quality(docs.filter("false"), rule_ensemble.fit_quality(docs.filter("false"), labels)).collect() == []


# near-duplicates


def brute_components(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(5)
    pairs = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 140)] + [tuple(sorted((rng.randint(200, 260), rng.randint(200, 260)))) for _ in range(40)] + [(-5, 3), (-5, 3)]
    df = spark.createDataFrame(pairs, "a long, b long")
    got = {r.node: r.root for r in components.components(df).collect()}
    want = brute_components(pairs, {n for p in pairs for n in p})
    assert got == {n: r for n, r in want.items() if n != r}
    assert components.components(df.filter("false")).collect() == []


def linked(fps, bits=simhash.MAX_BITS):
    return [(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if bin((a ^ b) & (2**64 - 1)).count("1") <= bits]


@pytest.mark.parametrize("tile", [2048, 40])
def test_links_connect_what_is_linked(spark, tile):
    rng = random.Random(tile)
    fps = {0, -1, -(2**63), 2**63 - 1}
    for _ in range(25):
        seed = rng.getrandbits(64) - 2**63
        for _ in range(rng.choice([1, 3, 60])):
            x = seed & (2**64 - 1)
            for _ in range(rng.randint(0, 5)):
                x ^= 1 << rng.randint(0, 63)
            fps.add(simhash._signed(x))
    fps = sorted(fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = [(r.a, r.b) for r in simhash.links(df, tile=tile).collect()]
    want = linked(fps)
    assert set(got) <= set(want) and brute_components(got, fps) == brute_components(want, fps)


def test_crowded_shards_stay_in_proportion(spark):
    """Two dense balls and stragglers beside them in one shard: all is found, and few rows meet other tiles."""
    rng = random.Random(4)
    centre, fps = 0x0123456789ABCDEF, set()
    for middle, n in ((centre, 900), (centre ^ 0x3F, 60)):  # six bits apart, linked only by way of others
        for _ in range(n):
            x = middle
            for _ in range(rng.randint(0, 2)):
                x ^= 1 << rng.randint(0, 40)
            fps.add(x)
    fps |= {centre ^ (0xFFFFF << k) for k in range(8)}
    fps = sorted(simhash._signed(f) for f in fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = [(r.a, r.b) for r in simhash.links(df, tile=50).collect()]
    want = linked(fps)
    assert set(got) <= set(want) and brute_components(got, fps) == brute_components(want, fps)


def test_pivots_discard_only_what_cannot_be_linked():
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    fps = np.concatenate([fps, fps ^ np.uint64(0b1011)])
    table = simhash.PivotTable(fps)
    i, j = np.triu_indices(len(fps), 1)
    hit = table.linked(i, j)
    assert set(hit.tolist()) == set(np.flatnonzero(np.bitwise_count(fps[i] ^ fps[j]) <= 4).tolist())


def test_near_duplicates_edges(spark):
    long = " ".join(f"word{i}" for i in range(70_000))
    rows = [(5, "A b c d e"), (3, "a B c d e"), (9, None), (8, ""), (7, " \n"), (1, long), (2, long.upper()), (4, "a b c d e"), (4, "a b c d e"), (None, "a b c d e"), (11, "one two")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("x")).withColumn("root", F.lit("y"))
    got = [(r.doc_id, r.fp, r.component_id) for r in simhash.near_duplicates(df).collect()]
    assert len(got) == len(rows)
    by_id = {i: c for i, _, c in got}
    assert by_id == {5: 3, 3: 3, 9: 7, 8: 7, 7: 7, 1: 1, 2: 1, 4: 3, None: 3, 11: 11}
    assert {f for i, f, _ in got if i in (7, 8, 9)} == {0}
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 7, 11]
    assert simhash.near_duplicates(df.filter("false")).collect() == []


# SentencePiece


def test_pieces_are_the_library_s(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = piece_bpe.load(path)
    rng = random.Random(2)
    parts = [" ", "  ", "a", "the", "ing", "\n", "\t", "▁", "é", "日本", "\U0001f600", "\0", "x" * 130, "ab" * 90, "   ", "1", "\r", "</s>", "<0x0A>", " \n", "\n ", "hello"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(600)] + ["", " ", "y" * 20_000, "w " * 60_000]
    texts += [r.text for r in documents(spark).collect()]
    encoder = piece_bpe.Encoder(model, remembered=500)
    flat, counts = encoder.encode(texts)
    ends = np.cumsum(counts)
    for text, n, end in zip(texts, counts, ends):
        ids = flat[end - n : end]
        want = model.library.encode(text)
        assert ids.tolist() == want and model.decode(ids) == model.library.decode(want)


def test_encode_documents_keeps_columns(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "", 6), (3, "a b", 7), (3, "a b", 7)], "doc_id long, text string, ids int")
    got = piece_bpe.encode_documents(df, public_tokenizers.path("piece_bpe_32k.model"), decode=True)
    assert got.columns == ["doc_id", "text", "ids", "decoded"]
    assert [(r.doc_id, len(r.ids), r.decoded) for r in got.orderBy("doc_id").collect()] == [(1, 0, ""), (2, 0, ""), (3, 2, "a b"), (3, 2, "a b")]
    assert piece_bpe.encode_documents(df.filter("false"), public_tokenizers.path("piece_bpe_32k.model")).collect() == []


# token files


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(3).integers(-(2**62), 2**62, 5000))
    h = token_files.PerfectHash.build(keys)
    assert sorted(h.numbers(keys).tolist()) == list(range(len(keys)))
    index = token_files.ShardIndex.from_bytes(token_files.ShardIndex(2, np.sort(keys), 0, np.arange(len(keys) + 1)).to_bytes())
    first, copies = index.lookup(np.sort(keys))
    assert first.tolist() == list(range(len(keys))) and (copies == 1).all()
    foreign, none = index.lookup(np.setdiff1d(np.arange(5000), keys))
    assert (foreign == -1).mean() > 0.999 and not none[foreign < 0].any()
    with pytest.raises(ValueError):
        token_files.ShardIndex.from_bytes(b"\1" + index.to_bytes()[1:])


def test_token_files_match_the_library(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    rows += [(-7, None), (-6, ""), (10_000, "<|startoftext|> a <|ENDOFTEXT|>."), (10_001, "İ. Σ. é. it's. x). 3.  日本。"), (10_002, "z" * 5000), (10_003, "w. " * 50_000), (-9, "same"), (-9, "same")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("x"))
    got = token_files.read_shards(token_files.write_shards(df, path, end_id=2)).orderBy("start").collect()
    library, start = Tokenizer.from_file(path), 0
    for r, (i, text) in zip(got, sorted(rows), strict=True):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    nulls = spark.createDataFrame([(None, "a b"), (1, "c")], "doc_id long, text string")
    assert [r.doc_id for r in token_files.read_shards(token_files.write_shards(nulls, path, end_id=2)).orderBy("start").collect()] == [None, 1]
    assert token_files.read_shards(token_files.write_shards(df.filter("false"), path, end_id=2)).collect() == []


@pytest.mark.parametrize("change", ["cased", "spaced"])
def test_token_files_of_other_tokenizers(spark, tmp_path, change):
    """A file that keeps case, or whose words hang on white space, is encoded text by text."""
    import json

    from tokenizers import Tokenizer

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = json.load(f)
    if change == "cased":
        spec["normalizer"]["normalizers"].pop()
    path = str(tmp_path / "tokenizer.json")
    if change == "spaced":
        path = public_tokenizers.path("byte_bpe_50k.json")
    else:
        with open(path, "w", encoding="utf-8") as f:
            json.dump(spec, f)
    rows = [(1, "The House, the HOUSE."), (2, None), (3, "  two  spaces\n"), (4, "<|endoftext|> É")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    library = Tokenizer.from_file(path)
    assert library.encode("The").ids != library.encode("the").ids
    got = token_files.read_shards(token_files.write_shards(df, path, end_id=2)).orderBy("doc_id").collect()
    for r, (i, text) in zip(got, rows, strict=True):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        assert (r.doc_id, r.n_tokens, r.ids_crc32) == (i, len(ids), zlib.crc32(ids.tobytes()))


def test_words_one_by_one_are_the_library_s():
    """Every settled character alone and inside words, special tokens in any case, and a memory that overflows."""
    import pyarrow as pa
    from tokenizers import Tokenizer

    path, rng = public_tokenizers.path("word_bpe_49k.json"), random.Random(3)
    library, encoder = Tokenizer.from_file(path), token_files.WordEncoder(path, remembered=300)
    chars = [chr(c) for c in range(1, 0x500)] + ["\u2c65", "\u3000", "\u65e5", "\u0301"]
    pools = [chars, chars[31:0x17F], ["'s", "'T", "x", "9", " ", "''", "'", "<|startoftext|>", "<|STARTofTEXT|>", "A", "\u00c9"]]
    texts = [f"a{c}b {c}" for c in chars] + ["".join(rng.choices(rng.choice(pools), k=rng.randint(0, 50))) for _ in range(600)]
    assert encoder.by_words
    for k in range(0, len(texts), 100):
        flat, counts = encoder.encode(pa.array([*texts[k : k + 100], None]))
        assert counts[-1] == 0
        for text, n, end in zip(texts[k : k + 100], counts, np.cumsum(counts)):
            assert flat[end - n : end].tolist() == library.encode(text, add_special_tokens=False).ids, text
    assert len(encoder.known) < 3000


def test_runs_of_documents():
    index = token_files.ShardIndex(2, np.arange(6), 0, np.array([0, 3, 3, 8, 9, 20, 21]))
    payload = io.BytesIO(np.arange(21, dtype="<u2").tobytes())
    payload.read_at = lambda n, at: payload.getvalue()[at : at + n]
    for size in (1, 5, 100):
        got = [x.tolist() for x in token_files.read_run(index, payload, np.array([0, 1, 2, 4, 5]), size)]
        assert got == [[0, 1, 2], [], [3, 4, 5, 6, 7], list(range(9, 20)), [20]]


# top-k


def brute_top(rows, k):
    out = []
    for q, v in rows:
        if q is not None and q % 20 == 0:
            scored = sorted(((-sum(int(a) * int(b) for a, b in zip(v, w)), i) for i, w in rows if i != q))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("shard,block", [(64, 8), (5000, 512)])
def test_top_k_matches_brute_force(spark, shard, block):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in np.floor(64 * rng.normal(size=6) / 3)]) for i in range(600)]
    rows += [(700 + i, rows[0][1]) for i in range(60)] + [(900, [0.0] * 6), (901, [1e15, -1e15, 3.0, 0.0, 0.0, 1.0]), (940, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, vector array<double>").withColumn("block", F.lit(1))
    got = top_k.top_k(df, F.col("id") % 20 == 0, shard=shard, block=block).collect()
    clamp = lambda s: min(max(s, -(1 << 63)), (1 << 63) - 1)
    assert sorted(map(tuple, got)) == [(q, n, i, clamp(s)) for q, n, i, s in brute_top(rows, 20)]


def test_top_k_edges(spark):
    rows = [(0, [1.0, None]), (20, None), (40, [float("nan"), 1.0]), (60, [0.5, -0.01]), (61, [float("inf"), 0.0]), (62, [1.0, 1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    ready = df.filter(top_k.usable(F.col("embedding"))).select(F.col("vec_id").alias("id"), top_k.floored(F.col("embedding")).alias("vector"))
    assert [tuple(r) for r in top_k.top_k(ready, F.col("id") % 20 == 0).collect()] == [(60, 1, 62, 32 * 64 - 64)]
    assert top_k.top_k(ready.filter("false"), F.col("id") % 20 == 0).collect() == []


# all together


def test_queries_run_on_whole_tables(spark):
    from spindrift.llm import queries

    n = {t: spark.read.parquet(f"{SF}/{t}.parquet").count() for t in ("documents", "pages")}
    assert queries.op1_warc(spark, SF).count() == n["pages"]
    for q in (queries.op2_quality_classifier, queries.op3_simhash, queries.op6_sentencepiece, queries.op7_token_files):
        assert q(spark, SF).select("doc_id").distinct().count() == n["documents"]


def test_pipeline_stages(spark):
    import corpus_pipeline as cp

    docs, kept = documents(spark), []
    for name, stage in cp.STAGES[:-1]:
        out = cp.materialize(stage(spark, docs, SF), name)
        assert out.columns == list(cp.DOCUMENT_COLUMNS)
        kept.append((name, docs, out))
        docs = out
    for name, before, after in kept[:3]:  # rows stay as they are
        assert after.exceptAll(before).count() == 0
    by_name = {n: (b, a) for n, b, a in kept}
    before, after = by_name["simhash_near_dedup"]
    groups = {r.doc_id: r.component_id for r in simhash.near_duplicates(before).collect()}
    assert sorted(r.doc_id for r in after.collect()) == sorted(set(groups.values()))
    final = cp.STAGES[-1][1](spark, docs, SF)
    assert final.count() == docs.count() > 0
    library = piece_bpe.load(public_tokenizers.path(cp.TOKENIZER)).library
    for r in final.limit(20).collect():
        assert r.n_tokens == len(r.ids) and library.decode(r.ids) == r.decoded
