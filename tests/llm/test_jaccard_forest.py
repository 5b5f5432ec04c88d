import random
import re

import pytest

from tallystone.llm.jaccard_forest import components, depth_for, depths_for, jaccard_join, levels_of, lowest_similarity

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(t):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows, threshold=0.8):
    sets = [shingles(t) or (("text", t) if t else None) for _, t in rows]
    n = len(rows)
    root, links = list(range(n)), [0] * n

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a is None or b is None:
                continue
            near = a == b if isinstance(a, tuple) or isinstance(b, tuple) else len(a & b) * 10 >= threshold * 10 * len(a | b) - 1e-6
            if near:
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    out = []
    for i in range(n):
        ids = [rows[j][0] for j in range(n) if find(j) == find(i) and rows[j][0] is not None]
        copies = sum(s == sets[i] for s in sets) if sets[i] is not None else 1
        out.append((rows[i][0], min(ids) if ids else None, links[i], copies))
    return sorted(out, key=str)


def corpus(groups=25, seed=1):
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcdefgh", k=r.randint(2, 6)))
    out = []
    for _ in range(groups):
        base = [word() for _ in range(r.randint(6, 160))]
        for _ in range(r.randint(1, 7)):
            w = list(base)
            for _ in range(r.randint(0, max(1, len(w) // 60))):
                w[r.randrange(len(w))] = word()
            out.append(" ".join(w))
    out += [out[0].upper(), out[0].replace(" ", ", "), "one two", "one two", "one, TWO!", "two one", "!!!", "!!!", "???", "", "", None, None]
    r.shuffle(out)
    return list(enumerate(out))


def run(spark, rows, **args):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(x) for x in jaccard_join(df, **args).collect()), key=str)


@pytest.mark.parametrize("args", [{}, {"light": 0}, {"block": 2}])
def test_against_brute_force(spark, args):
    rows = corpus()
    assert run(spark, rows, trees=40, deepest=3, **args) == brute(rows)


def test_default_recall(spark):
    rows = corpus(60, 7)
    got, want = run(spark, rows), brute(rows)
    found, there = sum(r[2] for r in got), sum(r[2] for r in want)
    assert there > 200 and found <= there and found >= 0.995 * there


def test_one_large_group_in_blocks(spark):
    r = random.Random(9)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(150):
        w = list(base)
        w[r.randrange(300)] = f"x{i}"
        rows.append((i, " ".join(w)))
    got = run(spark, rows, block=20, light=50, trees=40, deepest=3)
    assert got == brute(rows) and {g[1] for g in got} == {0}


def test_null_ids_repeats_long_text_empty_table(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(None, "a b c d e f g"), (None, "a b c d e f g"), (4, "a b c d e f g"), (4, "a b c d e f g"), (9, long), (8, long + " x"), (4, "z y"), (None, "q r")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


@pytest.mark.parametrize("n", range(1, 30))
def test_lowest_similarity(n):
    each = [i / (n + m - i) for m in range(1, 80) for i in range(1, min(n, m) + 1) if not n == m == i]
    near = [s for s in each if s >= 0.8 - 1e-12]
    assert lowest_similarity(n, 0.8) == (pytest.approx(min(near)) if near else None)


def test_classes_have_different_depths():
    depths = depths_for(0.8, 20, 8, 0.9995)
    assert [int(depths[n]) for n in (1, 2, 3, 4, 5, 6, 7, 8, 100, 512)] == [0, 0, 0, 5, 5, 6, 7, 5, 5, 5]
    for n in range(1, 40):  # any two sizes that can be near meet at the deeper of their depths
        for m in range(1, 40):
            if n * 0.8 <= m <= n / 0.8 and depths[n] and depths[m]:
                assert max(depths[n], depths[m]) in levels_of(n, depths, 0.8)
    assert levels_of(3, depths, 0.8) == [] and levels_of(7, depths, 0.8) == [7] and levels_of(8, depths, 0.8) == [5, 7]


def test_short_texts_meet_at_their_depths(spark):
    r = random.Random(5)
    rows = []
    for size in range(5, 20):
        for _ in range(6):
            w = [f"v{r.randrange(10**6)}" for _ in range(size)]
            rows += [" ".join(w), " ".join([*w, "z"]), " ".join(w[1:]), " ".join([*w, "z", "z"])]
    rows = list(enumerate(rows))
    got, want = run(spark, rows), brute(rows)
    assert sum(g[2] for g in got) >= 0.995 * sum(x[2] for x in want) > 200


def test_null_ids_meet_their_own_rows_only(spark):
    rows = []
    for g in range(60):
        w = [f"g{g}w{i}" for i in range(40)]
        rows += [(None, " ".join(w)), (None, " ".join([*w, "x"]))]
    assert run(spark, rows) == brute(rows)
    assert run(spark, [(7, t) for _, t in rows]) == brute([(7, t) for _, t in rows])


def twins():
    """Two words of 1,024 letters that agree in every sum of their letters with an odd base's powers modulo 2^64."""
    a = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    return a, a.translate(str.maketrans("ab", "ba"))


def test_words_that_a_polynomial_hash_confuses(spark):
    a, b = twins()
    rows = [(1, f"one two three {a} five six"), (2, f"one two three {b} five six")]
    assert run(spark, rows) == brute(rows) == [(1, 1, 0, 1), (2, 2, 0, 1)]


def test_extra_columns_and_names(spark):
    df = spark.createDataFrame([(1, "a b c d e f", 9, "x"), (2, "A b c d e, f", 8, "y")], "key long, n string, class_id int, bucket string")
    assert sorted(map(tuple, jaccard_join(df, "key", "n").collect())) == [(1, 1, 1, 2), (2, 1, 1, 2)]


def test_depth():
    assert depth_for(0.8, 20, 8, 0.9995) == 5
    assert depth_for(0.8, 1, 8, 0.99) == 1


def test_components(spark):
    r = random.Random(0)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100 + i, 100) for i in range(1, 30)] + [(r.randint(200, 220), r.randint(200, 220)) for _ in range(15)]
    got = {x["node"]: x["root"] for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}
    for a, b in edges:
        root.setdefault(a, a), root.setdefault(b, b)
    for _ in range(60):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert all(got.get(k, k) == v for k, v in root.items() if sum(k in e for e in edges if e[0] != e[1]))
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
