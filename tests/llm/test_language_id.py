import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tallystone.llm.language_id import BINS, MAX_N, SMOOTH, bins_of, fit, has_letter, identify, query, score, slices

EN = "the quick brown fox jumps over the lazy dog and then it sleeps in the sun "
FR = "le renard brun saute par dessus le chien paresseux et puis il dort au soleil "


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, text string, lang string")


def test_learns_and_defined_cases(spark):
    rows = [(i, EN[i:] + EN[: i * 2], "en") for i in range(20)] + [(100 + i, FR[i:] + FR[: i * 2], "fr") for i in range(20)] + [(900, FR, None), (901, None, "fr")]
    ask = [(1, "the dog and the fox"), (2, "le chien et le renard"), (3, None), (4, ""), (5, "12 34 !?"), (6, "the dog and the fox"), (7, "é"), (8, EN * 3000)]
    docs = spark.createDataFrame([(i, t, "zz") for i, t in ask], "doc_id long, text string, score string")
    out = {r["doc_id"]: r for r in identify(docs, frame(spark, rows)).collect()}
    assert [out[i]["lang_pred"] for i in range(1, 9)] == ["en", "fr", "und", "und", "und", "en", out[7]["lang_pred"], "en"]
    assert out[7]["lang_pred"] in ("en", "fr")
    assert all(0 <= out[i]["_score"] <= 1 for i in out) and out[1]["_score"] == out[6]["_score"]
    assert out[1]["score"] == "zz"


def test_nothing_learned(spark):
    docs = spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    assert identify(docs, frame(spark, [])).first()["lang_pred"] == "und"
    assert identify(docs.limit(0), frame(spark, [(1, EN, "en")])).collect() == []


def hashed(gram, bins):
    """The bin of an n-gram, one code point at a time, in plain integers."""
    m, h = (1 << 64) - 1, 0
    for c in gram:
        h = (h * 0x9E3779B97F4A7C15 + ord(c) + 1) & m
    h = (h + len(gram)) & m
    h = ((h ^ (h >> 31)) * 0x7FB5D329728EA185) & m
    h = ((h ^ (h >> 27)) * 0x81DADEF4BC2DD44D) & m
    return (h ^ (h >> 33)) & (bins - 1)


def grams(text):
    low = text.lower()
    return [hashed(low[i : i + n], BINS) for n in range(1, MAX_N + 1) for i in range(len(low) - n + 1)]


def test_against_brute_force(spark):
    """Naive Bayes with counts in dictionaries, one text at a time."""
    docs = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    known = [(t, x) for i, t, x in docs if not held(i) and t is not None and x is not None]
    langs = sorted({x for _, x in known})
    counts = {x: Counter(g for t, y in known if y == x for g in grams(t)) for x in langs}
    total = {x: sum(counts[x].values()) + SMOOTH * BINS for x in langs}
    prior = {x: math.log(sum(y == x for _, y in known) / len(known)) for x in langs}
    got = {r["doc_id"]: r for r in query(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(docs)
    for i, t, _ in docs:
        assert got[i]["held_out"] == held(i)
        if not t or not has_letter(t):
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0)
            continue
        log = {x: prior[x] + sum(math.log((counts[x][g] + SMOOTH) / total[x]) for g in grams(t)) for x in langs}
        best = max(langs, key=lambda x: (log[x], [-ord(c) for c in x]))
        assert got[i]["lang_pred"] == best
        assert abs(got[i]["score"] - 1 / sum(math.exp(v - log[best]) for v in log.values())) < 1e-6


def test_slices_change_nothing():
    langs, logp, prior = ["a", "b"], np.log(np.random.default_rng(0).random((33, 2)) + 0.1), np.zeros(2)
    logp[32] = 0
    texts = ["", "x", "abcdefghij" * 7, "é日" * 11, "ΑΣ ΟΔΟΣ"]
    for most in (1, 2, 5, 1000):
        parts = [x for part in slices(texts, 3, most) for x in zip(*part, strict=True)]
        for row, text in enumerate(texts):
            mine = sorted(g for r, low, own in parts if r == row for b in bins_of([low], 32, 3, np.array([own]))[0] for g in b[b < 32].tolist())
            assert mine == sorted(g for b in bins_of([text.lower()], 32, 3)[0] for g in b[b < 32].tolist())
    assert [x for x, _ in zip(*score(texts, langs, logp, prior, 3), strict=True)][:2] == ["und", score(["x"], langs, logp, prior, 3)[0][0]]


def test_fit_takes_a_sample_of_a_known_bound(spark):
    rows = frame(spark, [(i, EN[i % 50 :], "en") for i in range(4000)])
    counted = np.exp(fit(rows, max_train_rows=500)[2])
    assert counted[0] == 1 and fit(rows.limit(0))[0] == []


def test_grams_stay_inside_their_text():
    alone, _ = bins_of(["abcd"], 1 << 10, 3)
    among, offs = bins_of(["xy", "abcd", "", "z", "abcd"], 1 << 10, 3)
    for n in range(3):
        for i in (1, 4):
            assert among[n][offs[i] : offs[i + 1]].tolist() == alone[n].tolist()


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    out = query(spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right, n = out.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 100 and right > 0.97
