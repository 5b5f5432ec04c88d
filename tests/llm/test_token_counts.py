import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tallystone.llm.token_counts import MARK, UNKNOWN, Table, count_tokens, pieces, trie_counts


def brute(word, score):
    """Fewest pieces among the best segmentations."""
    n, longest = len(word), max(map(len, score))
    best = [(0.0, 0)] + [None] * n
    for e in range(1, n + 1):
        options = [(best[e - 1][0] + UNKNOWN, best[e - 1][1] + 1)]
        options += [(best[s][0] + score[word[s:e]], best[s][1] + 1) for s in range(max(0, e - longest), e) if word[s:e] in score]
        top = max(o[0] for o in options)
        best[e] = (top, min(o[1] for o in options if o[0] >= top))
    return best[n][1]


def test_model_pieces():
    of = pieces()
    score = {p.encode(): s for _, p, s in of}
    words = [x.encode() for x in ["▁the", "▁Zürich", "▁日本語", "▁supercalifragilistic", "▁", "▁x\x00y", "▁the", "▁thorreou", "▁" + "ab" * 300]]
    assert trie_counts(words, Table(of)).tolist() == [brute(w, score) for w in words]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abcé", max_size=12), min_size=1, max_size=12, unique=True))
def test_small_table(words):
    of = [(0, "a", -1.0), (1, "ab", -1.5), (2, "b", -2.0), (3, "abc", -9.0), (4, "é", -3.0), (5, "ca", -2.5)]
    score = {p.encode(): s for _, p, s in of}
    raw = [w.encode() for w in words]
    assert trie_counts(raw, Table(of)).tolist() == [brute(w, score) for w in raw]


def test_documents(spark):
    score = {p.encode(): s for _, p, s in pieces()}
    rows = [(1, "the quick  brown\tfox"), (2, None), (3, ""), (4, " \n "), (5, "the quick  brown\tfox"), (6, "été " * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("doc_id", "n_words")
    out = {r["n_words"]: (r["_n_words"], r["n_tokens"]) for r in count_tokens(df).collect()}
    for i, t in rows:
        words = (t or "").split()
        assert out[i] == (len(words), sum(brute((MARK + w).encode(), score) for w in set(words)) if i != 6 else 5000 * brute("▁été".encode(), score)) if i != 1 else out[i][0] == 4
    assert out[1] == out[5]
    assert count_tokens(df.limit(0)).collect() == []
    assert np.isfinite(UNKNOWN)


def test_words_that_a_polynomial_hash_confuses(spark):
    from .test_jaccard_forest import twins

    score = {p.encode(): s for _, p, s in pieces()}
    rows = list(enumerate([*twins(), "x"]))
    out = {r["doc_id"]: r["n_tokens"] for r in count_tokens(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()}
    assert out == {i: brute((MARK + t).encode(), score) for i, t in rows}
