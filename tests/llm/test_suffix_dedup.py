import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallystone.llm.suffix_dedup import anchors, remove_repeats, repeated, suffix_order


@settings(max_examples=150, deadline=None)
@given(st.binary(min_size=0, max_size=80).map(lambda b: bytes(x % 3 for x in b)), st.sampled_from([3, 4, 9, 20, 200]))
def test_suffix_order(data, length):
    x = np.frombuffer(data, np.uint8).astype(np.int64) + 1
    order = suffix_order(x, 257, length).tolist()
    assert sorted(order) == list(range(len(data)))
    prefixes = [data[i : i + length] for i in order]
    assert prefixes == sorted(prefixes)


@pytest.mark.parametrize("data", [b"a" * 5000, b"ab" * 3000, b"abc" * 2000, bytes(random.Random(2).choices(b"ab", k=6000)), bytes(range(256)) * 30])
def test_suffix_order_of_runs(data):
    order = suffix_order(np.frombuffer(data, np.uint8).astype(np.int64) + 1, 257, 200).tolist()
    assert sorted(order) == list(range(len(data)))
    prefixes = [data[i : i + 200] for i in order]
    assert prefixes == sorted(prefixes)


def test_anchors_cover_all_windows_alike():
    r = random.Random(5)
    for text in [bytes(r.choices(b"abcd", k=900)), b"a" * 700, b"ab" * 400, b"xyz" * 100 + bytes(r.choices(b"abcd", k=300))]:
        data = np.frombuffer(text, np.uint8)
        h, lo, hi, _ = anchors(data, 50, 16)
        assert lo[0] == 0 and hi[-1] == len(text) - 50 and (lo[1:] == hi[:-1] + 1).all()
        owner = {}
        for a, b, x in zip(lo.tolist(), hi.tolist(), h.tolist(), strict=True):
            for i in range(a, b + 1):
                assert owner.setdefault(text[i : i + 50], x) == x


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    n = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if n[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans, at = [], 0
        while (at := gone.find(1, at)) >= 0:
            to = gone.find(0, at)
            to = len(b) if to < 0 else to
            spans.append((at, to))
            at = to
        out.append((spans, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return out


def corpus():
    r = random.Random(11)
    text = lambda n: "".join(r.choices("abcdeé ", k=n))
    shared = [text(300) for _ in range(4)]
    out = [None, "", "short", text(49), text(50), "a" * 500, "ab" * 200, text(2000)]
    for _ in range(50):
        parts = [text(r.randint(0, 120))]
        for _ in range(r.randint(0, 3)):
            s = r.choice(shared)
            a = r.randint(0, 200)
            parts += [s[a : a + r.randint(20, 200)], text(r.randint(0, 80))]
        out.append("".join(parts))
    out += [out[9], out[9], out[10], out[7][300:900], out[7] + out[7][:60]]
    return out


def run(spark, texts, **args):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(remove_repeats(df, **args).collect(), key=lambda r: r["doc_id"])
    return [([(x["a"], x["b"]) for x in r["removed"]], bytes(r["kept"])) for r in rows]


@pytest.mark.parametrize("args", [{}, {"chunk": 1}, {"crowd": 400}, {"crowd": 0}])
def test_against_brute_force(spark, args):
    texts = corpus()
    assert run(spark, texts, length=50, gram=16, **args) == brute(texts, 50)


def test_texts_of_a_repeated_letter_have_few_contexts(spark):
    for text in (b"a" * 100_000, b"ab" * 50_000, bytes(range(97, 107)) * 10_000):
        _, lo, hi, many = anchors(np.frombuffer(text, np.uint8), 200, 64)
        assert len(lo) <= 100 and many.all() and (hi - lo < 2048).all()
    r = random.Random(6)
    text = lambda n: "".join(r.choices("abcdefgh ", k=n))
    texts = ["a" * 5000, text(400) + "ab" * 2500 + text(300), "xyz" * 900 + text(3000) + "xyz" * 900, text(100) + "a" * 199 + "b", "q" * 70 + text(40) + "q" * 70 + text(900)]
    assert run(spark, texts) == brute(texts, 200)
    assert run(spark, texts, crowd=0) == brute(texts, 200)


def test_production_length(spark):
    r = random.Random(3)
    text = lambda n: "".join(r.choices("abcdefgh ", k=n))
    base = text(5000)
    texts = [base, text(100) + base[1000:1199] + text(50), text(100) + base[2000:2200] + text(9), text(30) + base[100:4000] + text(10) + base[4200:4700], "z" * 199, "z" * 199, "y" * 200, "y" * 200, "x" * 201]
    assert run(spark, texts) == brute(texts, 200)


def test_empty_and_clashing_names(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert remove_repeats(df).collect() == []
    df = spark.createDataFrame([(1, "a", 2, 3)], "doc_id long, text string, kept int, sd_t1 int")
    out = remove_repeats(df)
    assert out.columns == ["doc_id", "text", "kept", "sd_t1", "removed", "_kept"]
    assert bytes(out.first()["_kept"]) == b"a"


def test_whole_contexts_of_one_group():
    assert repeated([b"abcdefgh", b"xbcdefgy", b"zzzzzzzz"], 5) == [[(1, 7)], [(1, 7)], [(0, 8)]]
