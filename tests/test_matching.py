"""Weighted similarity and its join, and the vector grid, against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import alignment
from millrace.operators import labels, matching, search


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def plain(a, b):
    return 200 * common(a, b) / (len(a) + len(b)) if a or b else 100.0


def window(a, b):
    both = [(a, b)] * (len(a) <= len(b)) + [(b, a)] * (len(b) <= len(a))
    return max(max((plain(s, t[max(0, i) : i + len(s)]) for i in range(1 - len(s), len(t))), default=0.0) for s, t in both)


def slow(a, b):
    """The weighted score, spelled out."""
    if not a or not b:
        return 0.0
    x, y = sorted(a.split()), sorted(b.split())
    far = max(len(a), len(b)) / min(len(a), len(b))
    score, both, p, q = plain(a, b), set(x) & set(y), sorted(set(x) - set(y)), sorted(set(y) - set(x))
    if not x or not y:
        return score if far < 1.5 else max(score, (0.9 if far <= 8 else 0.6) * window(a, b))
    if far < 1.5:
        words = plain(" ".join(x), " ".join(y))
        if both and (not p or not q):
            words = 100.0
        else:
            front = " ".join(sorted(both))
            left, right = (" ".join([front, *r] if both else r) for r in (p, q))
            edits = len(" ".join(p)) + len(" ".join(q)) - 2 * common(" ".join(p), " ".join(q))
            words = max(words, 100 * (1 - edits / (len(left) + len(right))), *[plain(front, t) for t in (left, right) if both])
        return max(score, 0.95 * words)
    share = 0.9 if far <= 8 else 0.6
    words = 100.0 if both else max(window(" ".join(x), " ".join(y)), window(" ".join(sorted(set(x))), " ".join(sorted(set(y)))))
    return max(score, share * window(a, b), 0.95 * share * words)


def noise(rng, text):
    out = list(text)
    for _ in range(rng.randrange(4)):
        at = rng.randrange(len(out) + 1)
        out[at : at + rng.randrange(2)] = rng.choice(["", "x", "-", "e", " "])
    return "".join(out)


WORDS = ["uw", "umspannwerk", "station", "nord", "süd", "berlin", "a", "ab", "hafen", "110", "kv", "leitung", "ost"]


def names(rng, n):
    return [noise(rng, " ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 6)))) for _ in range(n)]


def test_scores_are_the_definitions():
    rng = random.Random(4)
    a, b = names(rng, 600), names(rng, 600)
    a += ["", " ", "x", "a" * 70, "ab " * 40, "é漢", "a a b"]
    b += ["x", "  ", "xyz abc def", "a" * 300 + "b", "ba " * 90, "漢é漢é", "b a a a a a a a"]
    assert alignment.weighted(a, b) == pytest.approx([slow(x, y) for x, y in zip(a, b, strict=True)], abs=1e-4)
    assert alignment.weighted([None, "a"], ["a", None]) == [None, None]
    # some known values: a word in common, another order, a part of a longer text
    assert alignment.weighted(["UW Nord", "Nord UW", "Hafen"], ["UW Nord", "UW Nord", "Umspannwerk Hafen Ost"]) == [100.0, 95.0, 90.0]


def test_common_subsequence_of_long_texts():
    rng = random.Random(9)
    for n in (199, 201, 1000):
        a, b = ("".join(rng.choice("abcé ") for _ in range(m)) for m in (60, n))
        assert alignment.lcs(a, b) == common(a, b) == alignment.lcs(b, a)
    assert alignment.windows([("gnu general", "word gnv generl " * 5000)])[0] == pytest.approx(window("gnu general", "word gnv generl " * 3))


@pytest.mark.parametrize("cutoff", [70.0, 75.0, 90.0])
def test_no_match_is_lost(spark, monkeypatch, cutoff):
    monkeypatch.setattr(matching, "PART_ROWS", 40)  # most pairs of characters are dealt to several parts
    rng = random.Random(int(cutoff))
    asked, known = sorted(set(names(rng, 120)) - {""}), [(i, t) for i, t in enumerate(names(rng, 250))]
    known += [(300, known[3][1]), (301, None), (302, " "), (None, "uw nord")]
    got = matching.aligned_matches(spark.createDataFrame([(n,) for n in asked] + [(None,)], "n string"), "n", spark.createDataFrame(known, "k long, l string").where("k is not null"), "k", "l", cutoff, k=5)
    clean = lambda t: " ".join(t.split())
    keys = {}
    for k, t in known:
        if k is not None and t and t.strip():
            keys[clean(t)] = min(k, keys.get(clean(t), k))
    want = set()
    for n in {clean(n) for n in asked} - {""}:
        scores = sorted(((-s, k, t) for t, k in keys.items() if (s := round(slow(n, t), 4)) >= cutoff))[:5]
        want |= {(n, k, t, round(-s, 3), r + 1) for r, (s, k, t) in enumerate(scores)}
    assert {(r["name"], r["key"], r["label"], round(r["score"], 3), r["rank"]) for r in got.collect()} == want
    with pytest.raises(ValueError, match="at least"):
        matching.aligned_matches(got, "name", got, "key", "label", cutoff=50.0)


def test_rare_places_come_first(spark, monkeypatch):
    """Candidate pairs per match: by rarity fewer than in the order of the characters; fewer still when counted."""
    rng = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyz"
    own = ["Umspannwerk " + "".join(rng.choice(letters) for _ in range(8)) for _ in range(300)]
    texts = matching._texts(spark.createDataFrame([(t,) for t in own], "t string"), "t", None).withColumn("key", F.col("text"))
    pairs = lambda counted: matching.aligned_candidates(texts, texts, 90.0, 10, counted).count()
    rare, held = pairs(False), pairs(True)
    monkeypatch.setattr(matching, "estimate", lambda counters, gram: F.ascii(gram))
    plain_order = pairs(False)
    assert held <= rare < plain_order
    assert len(own) <= held


def test_hot_places_are_split(spark, monkeypatch):
    monkeypatch.setattr(matching, "PART_ROWS", 10)
    rng = random.Random(6)
    own = sorted({"hot " + "".join(rng.choice("xyz") for _ in range(6)) for _ in range(400)})
    texts = matching._texts(spark.createDataFrame([(t,) for t in own], "t string"), "t", None)
    counters = matching.sketch(texts.select(F.explode(matching.places(F.col("text"))).alias("g")), "g")
    parts = {g: spark.range(1).select(matching._parts(counters, F.lit(g))).first()[0] for g in ("ho", "qq")}
    assert parts["ho"] >= len(own) // 10 and parts["qq"] == 1
    met = matching._met(texts, texts, F.col("an"), counters, counters)
    seen = [(r["a"], r["b"]) for r in met.select("a", "b").collect()]
    assert len(seen) == len(set(seen)) == len(own) ** 2  # all share "ho": each pair once, whatever the parts


def brute(ids, q, others, x, k):
    out = set()
    for i, v in zip(ids, q, strict=True):
        raw = x @ v
        s = np.sign(raw) * np.floor(np.abs(raw) * 1e6 + 0.5) / 1e6
        order = [j for j in np.lexsort((others, -s)) if others[j] != i][:k]
        out |= {(int(i), int(others[j]), round(float(s[j]), 6), r + 1) for r, j in enumerate(order)}
    return out


def test_vector_grid(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(900, 6))
    x[100:200] = x[100]  # ties
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(None, [0.0] * 6), (1000, None)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    for block in (64, 5000):
        got = search.vector_matches(df.where("id % 3 = 0"), df, "id", "v", k=4, block=block)
        assert {(r["query_id"], r["vec_id"], round(r["score"], 6), r["rank"]) for r in got.collect()} == brute(np.arange(0, 900, 3), x[::3], np.arange(900), x, 4)
    assert search.vector_matches(df.where("id < 0"), df, "id", "v").count() == 0


def test_vector_grid_of_many_queries(spark):
    """100,000 queries: 13 x 1 cells of at most about 16,384 rows each, nothing collected."""
    df = spark.range(100_000).select("id", F.array(*[((F.xxhash64("id", F.lit(d)) % 1000) / 1000.0) for d in range(8)]).alias("v"))
    few = df.where("id < 3000")
    got = search.vector_matches(df, few, "id", "v", k=2)
    assert got.count() == 200_000
    x = np.array([r["v"] for r in few.orderBy("id").collect()])
    ask = df.where("id in (5, 77777, 99999)").orderBy("id").collect()
    mine = {(r["query_id"], r["vec_id"], round(r["score"], 6), r["rank"]) for r in got.where("query_id in (5, 77777, 99999)").collect()}
    assert mine == brute(np.array([r["id"] for r in ask]), np.array([r["v"] for r in ask]), np.arange(3000), x, 2)


@pytest.mark.parametrize("parts", [1, 3])
def test_triplets_take_texts_before_they_meet(spark, monkeypatch, parts):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "a", "b", None]), i, rng.choice([1, 1, 0, None])) for i in range(90)]
    held = spark.createDataFrame(rows, "anchor string, id long, label int")
    told = {i: f"text {i % 40}" if i % 7 else None for i in range(80)}
    texts = spark.createDataFrame(list(told.items()), "key long, text string")
    monkeypatch.setattr(labels, "BLOCK", 5, raising=False)
    for own, of in ((texts, told), (None, {i: i for _, i, _ in rows})):
        got = labels.triplets(held, "anchor", "id", "label", texts=own, key="key", parts=parts)
        want = [(a, of[i], of[j]) for a, i, x in rows for b, j, y in rows if a and a == b and (x, y) == (1, 0) and i in of and j in of]
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
        last = next(line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line)
        assert "anchor#" in last  # the product comes last: no pair is shuffled


def test_triplets_join_arrays_instead_of_pairs(spark, monkeypatch):
    """100 accepted and 300 rejected ones, of which some repeat and some texts are null: 30,000 rows of which the join makes at most 4,000."""
    monkeypatch.setattr(labels, "BLOCK", 128)
    monkeypatch.setattr(labels, "MET", 32, raising=False)
    held = spark.range(400).selectExpr("'a' AS anchor", "id", "if(id < 100, 1, 0) AS label")
    texts = spark.range(400).selectExpr("id AS key", "if(id % 7 = 0, null, concat('text ', id % 50)) AS text")
    got = labels.triplets(held, "anchor", "id", "label", texts=texts, key="key", parts=2)
    told = [None if i % 7 == 0 else f"text {i % 50}" for i in range(400)]
    want = Counter(("a", p, n) for p in told[:100] for n in told[100:])
    assert Counter(map(tuple, got.collect())) == want
    plan = [line for line in got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()]
    top = [next(k for k, line in enumerate(plan) if word in line) for word in ("Generate explode(_negatives", "Join")]
    assert top[0] < top[1]
