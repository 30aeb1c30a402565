"""Whole queries against plain Python: packing, nearest neighbours, language counts."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import langid, queries

SMALL = "/root/testdata/sf0.001"


def test_packing_query_by_brute_force(spark, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    tokenizer = tokenizers.Tokenizer.from_file(pytest.importorskip("public_tokenizers").path("word_bpe_49k.json"))
    held = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    held += [(None, "a null id"), (7, None), (9001, ""), (9002, "one two " * 3000)]
    spark.createDataFrame(held, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op4_packing(spark, str(tmp_path)).collect()
    want = Counter()
    for key, text in held:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            own = ids[start : start + 2048]
            want[key, piece, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 2048
    total = sum(r["length"] for r in got)
    assert len(sequences) <= max(-(-total // 2048) * 1.1 + 2, sum(r["length"] > 1024 for r in got) * 1.02 + total / 2048)


def test_nearest_query_scores_and_ranks(spark):
    rows = [(r["vec_id"], np.array(r["embedding"], "f8")) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    vectors = dict(rows)
    got = {}
    for r in queries.op5_ann(spark, SMALL).collect():
        got.setdefault(r["query_id"], []).append(r)
    assert set(got) == {i for i in vectors if i % 20 == 0}
    for q, found in got.items():
        found.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(1, min(20, len(rows) - 1) + 1)) and len({r["vec_id"] for r in found}) == len(found)
        assert all(r["score"] == pytest.approx(float(vectors[q] @ vectors[r["vec_id"]]), rel=1e-12) for r in found)
        assert [(-r["score"], r["vec_id"]) for r in found] == sorted((-r["score"], r["vec_id"]) for r in found)


def test_language_counts_by_brute_force(spark):
    """The model's weights are the log shares of the hashed n-grams of all training texts, half a count in each cell."""
    texts = [("en", "the cat and the dog"), ("de", "der hund und die katze"), ("en", "a house"), ("de", "Ein Haus!"), ("en", None), (None, "nothing")]
    df = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(texts)], "doc_id long, text string, lang string")
    model = langid.train(df, F.lit(True), bits=10)
    assert model.langs == ["de", "en"]
    counts = np.full((2, 1 << model.bits), 0.5)
    for lang, text in texts:
        if lang and text:
            codes = langid.folded(text.encode())
            for n in langid.GRAMS:
                for cell in langid.cells(codes, n, model.bits).tolist():
                    counts[model.langs.index(lang), cell] += 1
    assert np.allclose(model.weights, np.log(counts / counts.sum(axis=1, keepdims=True)))
    assert np.allclose(np.exp(model.prior), [2 / 5, 3 / 5])
