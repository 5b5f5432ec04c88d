from hypothesis import given, settings
from hypothesis import strategies as st

from tallystone.llm.sp_lattice import MARK, Joins, decode, encode, pretokens
from tallystone.llm.token_counts import UNKNOWN, pieces

PIECES = {p: (i, s) for i, p, s in pieces()}
LONGEST = max(map(len, PIECES))


def brute_word(word):
    if word == "":
        return [3 + b for b in MARK.encode()]
    best = [(0.0, [])]
    for e in range(1, len(word) + 1):
        top = (best[e - 1][0] + UNKNOWN, best[e - 1][1] + [3 + b for b in word[e - 1].encode()])
        for s in range(max(0, e - LONGEST), e):
            if (hit := PIECES.get(word[s:e])) and best[s][0] + hit[1] > top[0]:
                top = (best[s][0] + hit[1], best[s][1] + [hit[0]])
        best.append(top)
    return best[-1][1]


def brute(text):
    return [i for w in pretokens(text or "") for i in brute_word(w)]


def run(spark, rows, **args):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return {r["doc_id"]: (list(r["ids"]), r["decoded"]) for r in decode(encode(df, **args)).collect()}


def check(spark, rows, **args):
    got = run(spark, rows, **args)
    for i, t in rows:
        assert got[i][0] == brute(t), (i, t)
        assert got[i][1] == (t or "")


def test_against_brute_force(spark):
    rows = [(1, "The quick brown fox, jumped!"), (2, None), (3, ""), (4, " "), (5, "  two  spaces  "), (6, "line\nline\n\n"), (7, "日本語 text 😀😀 é́"), (8, f"a{MARK}b {MARK}{MARK}c{MARK}"), (9, "\x00\x01\t\r"), (10, "x" * 500), (11, " " * 100), (12, "The quick brown fox, jumped!"), (13, "ñ" * 200), (14, "\n")]
    check(spark, rows)
    check(spark, rows, chunk=10)


def test_long_text_empty_table_and_names(spark):
    rows = [(1, "some words, repeated many times\n" * 5000), (2, "thorreou " * 3000)]
    got = run(spark, rows)
    assert all(got[i][1] == t for i, t in rows)
    assert run(spark, []) == {}
    df = spark.createDataFrame([(1, "ab", "k", None)], "doc_id long, text string, ids string, chunk int")
    r = decode(encode(df), ids_col="_ids").first()
    assert (r["ids"], r["decoded"], r["chunk"]) == ("k", "ab", None)


def test_decoding_in_the_same_tasks(spark):
    rows = [(1, "The quick  brown\nfox é日"), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (list(r["ids"]), r["decoded"]) for r in encode(df, decoded_col="decoded").collect()}
    assert got == {i: (brute(t), t or "") for i, t in rows}


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(alphabet="abthe ▁\né日\x00", max_size=40), min_size=1, max_size=10))
def test_any_text(spark, texts):
    check(spark, list(enumerate(texts)))


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab ▁\n", max_size=200))
def test_pretokens_hold_the_text(text):
    words = pretokens(text)
    assert "".join("\0" if w == "" else w for w in words) == (MARK if text else "") + text.replace(MARK, "\0").replace(" ", MARK) or not text


def test_no_piece_is_cut():
    joins = Joins(pieces())
    assert [p for p in PIECES if joins.cut(p) != [p]] == []


def test_best_path_over_whole_words(spark):
    texts = ["x_{1}^{2} and a\\_b ->_c d._e __(self) }_{", "self.__init__(a_b, *args) // ----- ==== {{}}();", "word" * 40, "incomprehensibilities" * 5 + "_{" * 30, " " * 40 + "return x_{i}", "日本語_{ñ}é._", "".join(p.replace(MARK, " ") for p in list(PIECES)[1000:1200])]
    got = run(spark, list(enumerate(texts)))
    for i, t in enumerate(texts):
        assert got[i] == (brute_word(MARK + t.replace(" ", MARK)), t), t
