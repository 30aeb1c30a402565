"""Vector codes, conversation tries and SentencePiece against brute force and the library."""

import hashlib
import math
import random
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.llm import codes, prefix_trie, queries
from millrace.llm import sentencepiece_bpe as spm

MODEL = pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")


def plain_codes(rows, parts, entries, rounds, scale=256):
    """[(id, label, vector)] -> ([(id, code, error)], codebooks) with Python integers."""
    kept = [(i, lab, [math.floor(scale * x) for x in v]) for i, lab, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    size = max(1, -(-max((len(v) for *_, v in kept), default=0) // parts))
    cut = [[(v + [0] * (parts * size))[p * size : (p + 1) * size] for p in range(parts)] for *_, v in kept]
    first = {}
    for (i, *_), v in zip(kept, cut, strict=True):
        first[i] = min(first.get(i, v), v)
    seeds = sorted(first, key=lambda i: (i is None, i or 0))[:entries]
    books = [[list(first[i][p]) for i in seeds] for p in range(parts)]

    def nearest(x, book):
        far = [sum((a - b) ** 2 for a, b in zip(x, c, strict=True)) for c in book]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        at = [[nearest(v[p], books[p])[0] for p in range(parts)] for v in cut]
        for p in range(parts):
            for e in range(len(seeds)):
                own = [v[p] for v, a in zip(cut, at, strict=True) if a[p] == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    found = [[nearest(v[p], books[p]) for p in range(parts)] for v in cut]
    return [(i, lab, [c for c, _ in f], sum(d for _, d in f)) for (i, lab, _), f in zip(kept, found, strict=True)], books


def check_codes(spark, rows, **how):
    df = spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")
    out = codes.compress(df.withColumn("code", F.lit(1)).withColumn("id", F.lit("x")), "vec_id", "embedding", "label", **how)
    want, books = plain_codes(rows, how["parts"], how["entries"], how["rounds"])
    sums = {}
    for _, lab, _, d in want:
        sums[lab] = sums.get(lab, 0) + d
    got = sorted(((r["id"], r["label"], r["code"], r["error"], r["label_error"]) for r in out.rows.collect()), key=repr)
    assert got == sorted([(i, lab, c, d, sums[lab]) for i, lab, c, d in want], key=repr)
    assert out.books.tolist() == books
    return out


def test_codes_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "b", None]), [rng.gauss(0, 0.3) for _ in range(8)]) for i in rng.sample(range(1000), 150)]
    rows += [(2000 + i, "a", [float(rng.randrange(2)) for _ in range(8)]) for i in range(60)]  # many ties
    rows += rows[:20]  # repeated rows
    out = check_codes(spark, rows, parts=4, entries=9, rounds=2)
    assert out.sha256() == hashlib.sha256(",".join(str(x) for p in out.books.tolist() for e in p for x in e).encode()).hexdigest()


def test_codes_odd_rows(spark):
    odd = [(1, "a", None), (2, "a", [1.0, None]), (3, "a", [float("nan"), 1.0]), (4, None, [float("inf"), 1.0]), (5, None, []), (6, "a", [1.5]), (7, "a", [0.25, -0.001, 3.0])]
    odd += [(None, "a", [9.0, 9.0]), (7, "b", [0.0, 0.0, 0.0]), (8, None, [1e5, -1e5]), (9, None, [3e6, 2.0, -3e6])]
    check_codes(spark, odd, parts=2, entries=64, rounds=2)
    check_codes(spark, odd, parts=2, entries=2, rounds=3)
    far = spark.createDataFrame([(1, "a", [1e30]), (2, "a", [4e15]), (3, "a", [0.0]), (4, "b", [1.0])], "vec_id long, label string, embedding array<double>")
    got = {r["id"]: r for r in codes.compress(far, "vec_id", "embedding", "label", parts=1, entries=1, rounds=0).rows.collect()}
    assert set(got) == {2, 3, 4}  # 256e30 doesn't fit 62 bits
    assert got[2]["error"] == 0 and got[3]["error"] is None and got[3]["label_error"] is None and got[4]["code"] == [0]
    none = codes.compress(far.where("vec_id > 9"), "vec_id", "embedding", "label")
    assert none.rows.count() == 0 and none.books.size == 0


def test_nearest_entries_are_exact():
    rng = np.random.default_rng(5)
    for scale in (3, 300, 1 << 13, 1 << 24, 1 << 26):
        book = rng.integers(-scale, scale, (16, 5))
        x = np.concatenate((rng.integers(-scale, scale, (300, 5)), (book[rng.integers(0, 16, 300)] + book[rng.integers(0, 16, 300)]) // 2))
        far = ((x[:, None, :] - book[None]) ** 2).sum(axis=2)
        at, best = codes.nearest_entries(x, book)
        assert (at == far.argmin(axis=1)).all() and (best == far.min(axis=1)).all()


def plain_trie(convs):
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    words = lambda t: len([w for w in t[1].replace("\t", " ").replace("\n", " ").split(" ") if w])
    out = []
    for key, members in nodes.items():
        below = [k for k in nodes if k[: len(key)] == key]
        ends = sorted(c for c in members if len(convs[c]) == len(key))
        leaves = sum(not any(len(k) == len(b) + 1 and k[:-1] == b for k in below) for b in below)
        saved = sum((len(nodes[b]) - 1) * words(b[-1]) for b in below if b)
        children = sum(len(k) == len(key) + 1 for k in below)
        out.append((min(members), len(key), min(nodes[key[:-1]]) if key else None, len(members), children, leaves, saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


@pytest.mark.parametrize("per_block", [1, 5, 40, 10_000])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_trie_brute_force(spark, per_block, seed):
    rng = random.Random(seed)
    convs = {}
    for c in rng.sample(range(500), 60):
        same = rng.random() < 0.3
        convs[c] = [("user", "hot turn here")] * 3 if same else [(rng.choice("ab"), rng.choice(["x", "y z", "w w w"])) for _ in range(rng.randrange(0 if seed > 1 else 1, 6))]
    rows = [(c, t, *turn) for c, turns in convs.items() for t, turn in enumerate(turns)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    seq = prefix_trie.sequences(df)
    empty = spark.createDataFrame([(c,) for c, t in convs.items() if not t], "conv_id long")
    seq = seq.unionByName(empty.withColumn("seq", F.array().cast(seq.schema["seq"].dataType)))
    got = prefix_trie.trie(seq, turns_per_block=per_block)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=repr) == plain_trie(convs)


def test_trie_odd_rows(spark):
    rows = [(1, None, None, None, 5), (1, 0, "u", "a b", 5), (1, 0, "u", "a b", 5), (2, 3, "", "", 5), (2, 5, "u", "a b", 5), (None, 1, "u", "x", 5), (3, 1, "1:", "b", 5), (4, 1, "1", ":b", 5), (5, 1, "u", "long " * 50_000, 5)]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string, seq int")
    convs = {1: [("", ""), ("u", "a b"), ("u", "a b")], 2: [("", ""), ("u", "a b")], 3: [("1:", "b")], 4: [("1", ":b")], 5: [("u", "long " * 50_000)]}
    got = prefix_trie.trie(prefix_trie.sequences(df))
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=repr) == plain_trie(convs)
    assert prefix_trie.trie(prefix_trie.sequences(df.where("conv_id > 9"))).count() == 0


def test_trie_query_rebuilds(spark, tmp_path):
    rng = random.Random(8)
    own = {c: [("user" if k % 2 else "assistant", f"{rng.randrange(3)} said") for k in range(rng.randrange(1, 6))] for c in range(20, 110) if c != 60}
    spark.createDataFrame([(c, k, *t) for c, turns in own.items() for k, t in enumerate(turns)], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    got = queries.op12_prefix_trie(spark, str(tmp_path)).collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got), key=repr) == plain_trie(built)


def texts():
    rng = random.Random(11)
    signs = ["a", "b", "th", "e ", " ", "  ", "▁", "\n", "\t", "<s>", "</s>", "é", "漢", "字", "😀", "́", "​", "\x00", "1", "23", "'", "　", "ﬁ", "<0x41>", "�"]
    return ["", " ", "▁", "<unk>", *["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(3000)], "ab" * 60_000, "x " * 60_000, " " * 5_000]


def test_pieces_are_the_librarys():
    own, all_ = spm.Pieces(MODEL), spm.Pieces(MODEL).encode_all(texts())
    for t, together in zip(texts(), all_, strict=True):
        assert own.encode(t) == together
        ids = np.frombuffer(own.encode(t), "u4").tolist()
        assert ids == own.library.encode(t)
        assert own.decode(ids) == own.library.decode(ids) == t.replace("▁", " ") == own.decode_all([np.array([1, *ids, 2])])[0]
    rng = random.Random(2)
    for _ in range(5000):  # ids that no text gives: broken bytes, unknown and control ids
        ids = [rng.choice([rng.randrange(32_000), rng.randrange(260), 259, 28_705, 0, 1, 2, 229, 153, 132]) for _ in range(rng.randrange(9))]
        assert own.decode(ids) == own.library.decode(ids) == own.decode_all([np.array(ids, "u4")])[0]


def test_pieces_forget(monkeypatch):
    monkeypatch.setattr(spm, "CACHE", 3)
    own = spm.Pieces(MODEL)
    assert np.frombuffer(own.encode("one two three four five one two"), "u4").tolist() == own.library.encode("one two three four five one two")
    assert own.encode_all(["six seven", "one"]) == [own.encode("six seven"), own.encode("one")] and len(own.known) <= 3


def test_sentencepiece_rows(spark, tmp_path):
    rows = [(i, t.replace("\x00", "") or None, "clash") for i, t in enumerate(texts()[:400])] + [(None, None, None), (7, "again", "x"), (7, "again", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    lib = spm.pieces(MODEL).library
    got = spm.encoded(df, F.col("text"), MODEL, decode=True).collect()
    want = {(r[0], r[1]): lib.encode(r[1] or "", add_bos=True, add_eos=True) for r in rows}
    assert len(got) == len(rows)
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert ids == want[(r["row"]["doc_id"], r["row"]["text"])] and r["decoded"] == lib.decode(ids)
    back = spm.decoded(spm.encoded(df, F.col("text"), MODEL).select("row.doc_id", "row.text", "ids"), F.col("ids"), MODEL).collect()
    assert all(r["text"] == (r["row"]["text"] or "").replace("▁", " ") for r in back)
    assert spm.encoded(df.where("doc_id > 9999"), F.col("text"), MODEL).count() == 0
    df.drop("ids").write.parquet(f"{tmp_path}/documents.parquet")
    seen = queries.op13_sentencepiece(spark, str(tmp_path)).toPandas()
    for r in seen.itertuples():
        own = [i for k, i in want.items() if (k[0] == r.doc_id or (k[0] is None and pd.isna(r.doc_id))) and hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest() == r.ids_sha256]
        assert own and len(own[0]) == r.n_tokens and hashlib.sha256(lib.decode(own[0]).encode()).hexdigest() == r.decoded_sha256
