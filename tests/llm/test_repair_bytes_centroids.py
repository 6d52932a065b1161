"""Conversation repair, byte-level BPE and centroid clustering against brute force and the library."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spindrift.llm import byte_bpe, centroids, conversation_repair, queries

BYTES = public_tokenizers.path("byte_bpe_50k.json")


# conversation repair


def brute_repair(rows):
    """(cost, audit, repaired) of rows (role, text, fault) by trying all edits, the cheapest states kept turn by turn."""
    states = {"": (0, "", ())}  # by the roles so far, without pairs that repeat

    def better(table, key, value):
        if key not in table or value < table[key]:
            table[key] = value

    def grow(table):
        out = dict(table)
        for _ in range(3):
            for key, (cost, audit, done) in list(out.items()):
                for role in ("user", "assistant"):
                    new = key + role[0]
                    if re.fullmatch("s?(ua)*u?", new):
                        better(out, shrink(new), (cost + 2, audit + "I", (*done, (role, ""))))
        return out

    def shrink(key):
        while "uaua" in key:
            key = key.replace("uaua", "ua", 1)
        return key

    for role, text, fault in rows:
        states, nxt = grow(states), {}
        for key, (cost, audit, done) in states.items():
            better(nxt, key, (cost + 3, audit + "D", done))
            if fault in ("", "truncated"):
                cost += fault == "truncated"
                for op, price, name in (("K", 0, role), ("R", 2, "user"), ("R", 2, "assistant")):
                    new = key + (name[:1] or "?")
                    if re.fullmatch("s?(ua)*u?", new):
                        better(nxt, shrink(new), (cost + price, audit + op, (*done, (name, text))))
        states = nxt
    return min(v for k, v in grow(states).items() if re.fullmatch("(s?(ua)+)?", k))


def brute_report(turns):
    """What the operator should say of one conversation's (turn, role, text)."""
    rows = sorted(((t is not None, t or 0), (" " if r is None else r).encode(), (" " if x is None else x).encode()) for t, r, x in turns)
    rows = [(t[1] if t[0] else None, r.decode(), x.decode()) for t, r, x in rows]
    seen, faults = set(), []
    for _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else "")
        seen.add((role, text))
    numbers = [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, repaired = brute_repair([(r, x, f) for (_, r, x), f in zip(rows, faults)])
    return [gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit], "\n".join(f"{r}:{x}" for r, x in repaired)


def random_turns(rng, n):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None, ""]
    texts = ["a.", "b!", "c", "d ?\n", "", "\t ", None, "e", "f.", "½."]
    out = []
    for k in range(n):
        text = rng.choice(texts)
        if text is not None and rng.random() < 0.5:
            text += f"{k}."
        out.append((rng.choice([k, k, k, None, k + 1]), rng.choice(roles), text))
    return out


@pytest.mark.parametrize("window", [1, 3, 512])
def test_repair_equals_brute_force(spark, monkeypatch, window):
    """Also with windows of so few turns that long conversations are settled piece by piece."""
    monkeypatch.setattr(conversation_repair, "WINDOW", window)
    rng = random.Random(window)
    talks = {c: random_turns(rng, rng.randrange(1, 14)) for c in range(60)} | {None: random_turns(rng, 5), 1000: random_turns(rng, 90)}
    rows = [(c, t, r, x, 1, "z") for c, turns in talks.items() for t, r, x in turns]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, first int, digest string")
    ordered = conversation_repair.in_order(df).repartition(1).sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text").collect()
    batch = pa.RecordBatch.from_pylist([r.asDict() for r in ordered], pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("seen", pa.bool_()), ("blank", pa.bool_()), ("truncated", pa.bool_())]))
    left, said = {}, {}
    for c, x in conversation_repair.repairs(iter([batch.slice(0, 7), batch.slice(7)])):
        if isinstance(x, conversation_repair.Report):
            said[c] = list(vars(x).values())[1:]
        elif x.op != "D":
            left.setdefault(c, []).append(f"{x.role}:{x.text}")
    for c, turns in talks.items():
        report, repaired = brute_report(turns)
        assert (said[c], "\n".join(left.get(c, []))) == (report, repaired), (c, turns)


def test_repair_rows_and_memory(spark):
    good = [(k, ("user", "assistant")[k % 2], f"t{k}.") for k in range(6000)]
    df = spark.createDataFrame([(1, *t) for t in good] + [(2, 0, "assistant", "x."), (3, 0, "user", "")], "conv_id long, turn long, role string, text string")
    got = conversation_repair.repair_conversations(df)
    assert got.filter("conv_id = 1").agg(F.count("*"), F.min("op"), F.max("op"), F.max("place")).first()[:] == (6000, "K", "K", 5999)
    assert [tuple(r)[2:] for r in got.filter("conv_id = 2").orderBy("place").collect()] == [("I", None, "user", ""), ("K", 0, "assistant", "x.")]
    assert [r.op for r in got.filter("conv_id = 3").collect()] == ["D"]
    assert conversation_repair.repair_conversations(df.filter("false")).collect() == []
    now = conversation_repair.Repair(1)
    for k in range(40 * conversation_repair.WINDOW):
        for _ in now.add(k, ("user", "assistant")[k % 2], f"{k}.", False, False, False):
            pass
        assert len(now.open_) <= 2 * conversation_repair.WINDOW


def test_repair_query_equals_plain_python(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect()
    talks = {}
    for r in rows:
        talks.setdefault(r.conv_id, [])
        kind = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", r.text) if kind == 2 else r.text
        talks[r.conv_id] += [(r.turn, "user" if kind == 4 else r.role, text)] * (0, 1, 1, 2, *[1] * 16)[kind]
    got = queries.op11_conversation_repair(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(talks)
    for r in got:
        report, repaired = brute_report(talks[r.conv_id]) if talks[r.conv_id] else ([0] * 6 + [""], "")
        assert [*r[1:8], r.repaired_sha256] == [*report, hashlib.sha256(repaired.encode()).hexdigest()]


# byte-level BPE


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.ByteEncoder(BYTES, remembered=500)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BYTES)


def encoded(encoder, texts):
    flat, n = encoder.encode(pa.array(texts, pa.string()))
    return [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])]


def test_ids_equal_the_library(encoder, library):
    rng = random.Random(4)
    alphabet = [*"ab e\n\t'tsrl.,!12", *"\u00a0\u3000\u00e9\u65e5\u672c\x1c\x85\u2028\u200b\u00bd", "<|endoftext|>", "  ", " the"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(50))) for _ in range(3000)]
    texts += [None, "", " ", "\n\n ", "日本語" * 4000, "a" * 20_001, "ab" * 9_000, "".join(rng.choice("abcdefghij") for _ in range(20_000)), " " * 5000 + "x", "<|endoftext|>" * 3]
    texts += ["".join(f"a{chr(c)}1{chr(c)}.{chr(c)} {chr(c)}\n" for c in range(k, k + 64)) for k in range(0, 0xD800, 64)]
    want = library.encode_batch([t or "" for t in texts], add_special_tokens=False)
    assert encoded(encoder, texts) == [e.ids for e in want]
    assert encoded(encoder, ["qzxwvk-9"]) == [library.encode("qzxwvk-9").ids] and len(encoder.known) < 600  # the rarer half has gone


def test_the_transducer_streams(encoder, library):
    merges, rng = encoder.merges, random.Random(8)
    assert 0 < merges.lookahead < 1000
    for text in ("".join(rng.choice("etaoin") for _ in range(9000)), "é日本" * 3000, "x" * 8000, "ing" * 3000):
        data, machine, out, most = text.encode(), byte_bpe.Transducer(merges), [], 0
        at = 0
        while at < len(data):
            n = rng.randrange(1, 400)
            out += machine.feed(data[at : at + n])
            at += n
            most = max(most, len(machine.held))
            assert sum(merges.length[i] for i in out) >= min(at, len(data)) - merges.window
        out += machine.finish()
        assert out == library.encode(text, add_special_tokens=False).ids and most <= merges.window


def test_the_lookahead_suffices():
    """On all strings over small merge lists: a token further from the end than the lookahead never changes."""
    rng = random.Random(2)
    for _ in range(30):
        tokens, pairs = ["a", "b", "c"], []
        for _ in range(rng.randrange(1, 7)):
            u, v = rng.choice(tokens), rng.choice(tokens)
            if u + v not in tokens:
                tokens.append(u + v)
                pairs.append((u, v))
        number = {t: k for k, t in enumerate(tokens)}
        look = byte_bpe.sufficient_lookahead([(number[u], number[v]) for u, v in pairs], [number[u + v] for u, v in pairs], {k: len(t) for t, k in number.items()})

        def merge(text):
            out = list(text)
            while True:
                found = [(pairs.index(p), k) for k, p in enumerate(zip(out, out[1:])) if p in pairs]
                if not found:
                    return out
                k = min(found)[1]
                out[k : k + 2] = [out[k] + out[k + 1]]

        for _ in range(150):
            text = "".join(rng.choice("abc") for _ in range(rng.randrange(2 * look + 12)))
            cut = rng.randrange(len(text) + 1)
            part, whole, end = merge(text[:cut]), merge(text), 0
            for k, token in enumerate(part):
                end += len(token)
                if end > cut - look:
                    break
                assert whole[k] == token, (pairs, text, cut)


def test_decoding_is_incremental(encoder, library):
    rng = random.Random(9)
    for _ in range(200):
        ids = [rng.randrange(50257) for _ in range(rng.randrange(40))]
        machine = byte_bpe.TextDecoder(encoder)
        got = "".join(machine.feed(np.array([i])) for i in ids) + machine.finish()
        assert got == library.decode(ids, skip_special_tokens=False)


def test_documents_round_trip(spark, library):
    rows = [(1, "a b", 5), (1, "a b", 5), (None, "ü <|endoftext|>", 6), (2, None, 7), (3, "", 8), (4, "日本 \n\n x" * 30_000, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, IDS int").repartition(3)
    got = byte_bpe.encode_documents(df, BYTES)
    want = sorted((str(i), library.encode(t or "").ids) for i, t, _ in rows)
    assert sorted((str(r.doc_id), r.ids) for r in got.collect()) == want
    assert sorted(r.text for r in byte_bpe.decode_documents(got, BYTES).collect()) == sorted(t or "" for _, t, _ in rows)
    assert byte_bpe.encode_documents(df.filter("false"), BYTES).collect() == []


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        byte_bpe.ByteEncoder(public_tokenizers.path("word_bpe_49k.json"))


def test_byte_query_equals_the_library(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = queries.op12_byte_bpe(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert r[1:] == (len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


# centroids


def brute_clusters(rows, k, rounds, dim, scale, salt):
    def fits(v):
        return v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)

    kept = [(i, tuple(math.floor(scale * x) for x in v)) for i, v in rows if fits(v)]
    seeds = sorted((i is None, hashlib.sha256(f"{salt}{i}".encode()).hexdigest() if i is not None else "", v) for i, v in kept)
    middle = [v for *_, v in seeds[:k]]

    def nearest():
        return [min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(middle)) for _, v in kept]

    for _ in range(rounds):
        of = nearest()
        for c in range(len(middle)):
            mine = [v for (_, v), (_, own) in zip(kept, of) if own == c]
            if mine:
                middle[c] = tuple(sum(x) // len(mine) for x in zip(*mine))
    return sorted((str(i), c, d) for (i, _), (d, c) in zip(kept, nearest())), middle


@pytest.mark.parametrize("seed", range(4))
def test_clusters_equal_brute_force(spark, monkeypatch, seed):
    rng = random.Random(seed)
    monkeypatch.setattr(centroids, "TREE", 40)
    dim, k = (3, 5) if seed % 2 else (2, 4)
    heart = [[rng.uniform(-40, 40) for _ in range(dim)] for _ in range(4)]
    rows = [(n, [h + rng.choice([0.0, 0.5, -0.5, rng.gauss(0, 1)]) for h in rng.choice(heart)]) for n in range(300)]
    rows += [(7, rows[7][1]), (None, [1.0] * dim), (None, [2.0] * dim), (400, None), (401, []), (402, [1.0] * (dim + 1)), (403, [None] + [1.0] * (dim - 1)), (404, [math.nan] * dim), (405, [math.inf] * dim)]
    rows += [(500 + n, [0.0] * dim) for n in range(150)]
    df = spark.createDataFrame([(i, v, 0, 1) for i, v in rows], "vec_id long, embedding array<float>, distance int, CLUSTER int").repartition(3)
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = centroids.cluster_vectors(df, k=k, rounds=6, dim=dim, scale=4.0)
    want, middle = brute_clusters(rows, k, 6, dim, 4.0, "3:")
    assert sorted((str(r.vec_id), r.cluster, r.distance) for r in got.assigned.collect()) == want
    assert [tuple(m) for m in got.centroids.tolist()] == middle


def test_balls_pass_whole():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.integers(-20, 20, (500, 8)) + 1000 * c for c in range(3)])
    tree = centroids.Balls.build(np.arange(1500), np.ones(1500, bool), points)
    tree = centroids.Balls.from_bytes(tree.to_bytes())
    middle = np.array([[1000 * c] * 8 for c in range(3)])
    own, balls, nodes = tree.assign(middle)
    assert (own >= 0).sum() < 500 and len(balls) > 0
    for (a, b, c), node in zip(balls, nodes):
        assert (tree.points[a:b].sum(axis=0) == tree.sums[node]).all() and (np.abs(tree.points[a:b] - middle[c]) <= 20).all()
        own[a:b] = c
    assert (own == centroids.squared(tree.points, middle).argmin(axis=1)).all()


def test_squares_are_exact():
    far = np.full((1, 64), centroids.LARGEST)
    assert centroids.squared(far, -far + 1).tolist() == [[64 * (2 * centroids.LARGEST - 1) ** 2]]


def test_few_none_and_too_large(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    got = centroids.cluster_vectors(df, dim=2)
    assert sorted(map(tuple, got.assigned.collect())) == [(1, 0, 0), (2, 0, 0)] and len(got.centroids) == 2
    none = centroids.cluster_vectors(df.filter("false"), dim=2)
    assert none.assigned.collect() == [] and len(none.centroids) == 0
    with pytest.raises(Exception, match="after scaling"):
        centroids.cluster_vectors(spark.createDataFrame([(1, [1e30, 0.0])], df.schema), dim=2)
