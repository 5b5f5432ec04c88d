import random
import re

from tallystone.llm.decontaminate import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items):
    wins = {}
    for i, t in items:
        w = words(t)
        m = min(13, len(w))
        for k in range(len(w) - m + 1 if m else 0):
            wins.setdefault(tuple(w[k : k + m]), set()).add("null" if i is None else str(i))
    out = []
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for m in {len(x) for x in wins}:
            for k in range(len(w) - m + 1):
                if (x := wins.get(tuple(w[k : k + m]))) is not None:
                    hit |= set(range(k, k + m))
                    ids |= x
        out.append((d, len(w), sorted(hit), sorted(ids), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def run(spark, docs, items, **args):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    return [tuple(r)[:1] + tuple(r)[2:] for r in decontaminate(d, b, **args).collect()]


def srt(rows):
    return sorted(rows, key=lambda r: (r[0] or -1, r))


def cases():
    r = random.Random(4)
    vocab = [f"w{i}" for i in range(60)] + ["été", "日本", "x"]
    text = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    items = [(i, text(r.randint(13, 40))) for i in range(12)] + [(50, text(13)), (51, text(12)), (52, text(3)), (53, "x"), (54, None), (55, "!!"), (None, text(20)), (0, text(15))]
    docs = []
    for i in range(60):
        t = text(r.randint(0, 200)).split()
        for _ in range(r.randint(0, 3)):
            src = words(r.choice(items)[1])
            a = r.randint(0, max(0, len(src) - 5))
            cut = src[a : a + r.randint(5, 30)]
            at = r.randint(0, len(t))
            t[at:at] = cut
        docs.append((i, r.choice([" ", ", ", "\n", "-"]).join(t).upper() if i % 3 else " ".join(t)))
    return docs + [(100, None), (101, ""), (102, "..."), (5, docs[5][1])], items


def test_against_brute_force(spark):
    docs, items = cases()
    got = run(spark, docs, items)
    assert srt(got) == srt(brute(docs, items))
    assert sum(g[-1] for g in got) > 10


def test_large_benchmark_by_joins(spark):
    docs, items = cases()
    assert srt(run(spark, docs, items, part_bytes=300)) == srt(brute(docs, items))
    assert run(spark, [], items, part_bytes=0) == []
    assert run(spark, [(1, "a b")], [], part_bytes=-1) == [(1, 2, [], [], False)]
    d = spark.createDataFrame([(1, "a b", "k", None)], "doc_id long, text string, items string, dc_k1 int")
    out = decontaminate(d, spark.createDataFrame([(1, "a b")], "item_id long, text string"), part_bytes=0).first()
    assert out["items"] == "k" and out["dc_k1"] is None and out["_items"] == ["1"] and out["contaminated"]


def test_long_and_repeated_words(spark):
    items = [(1, "a " * 30), (2, " ".join(f"q{i}" for i in range(40)))]
    docs = [(1, "a " * 50_000), (2, "b " * 20_000 + " ".join(f"q{i}" for i in range(10, 30)) + " b" * 20_000), (3, "q" * 500_000)]
    assert srt(run(spark, docs, items)) == srt(brute(docs, items))
    assert srt(run(spark, docs, items, part_bytes=0)) == srt(brute(docs, items))


def test_empty_sides_and_names(spark):
    assert run(spark, [], [(1, "a b")]) == []
    assert run(spark, [(1, "a b")], []) == [(1, 2, [], [], False)]
    d = spark.createDataFrame([(1, "a b", "k")], "doc_id long, text string, items string")
    out = decontaminate(d, spark.createDataFrame([(1, "a b")], "item_id long, text string")).first()
    assert out["items"] == "k" and out["_items"] == ["1"] and out["contaminated"]
