from hashlib import sha256

import corpus_pipeline
from tallystone.llm.sp_lattice import pretokens

from .test_decontaminate import brute as contaminated
from .test_jaccard_forest import brute as near
from .test_line_dedup import brute as lines


def test_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    rows = [(i, t) for i, t in rows if t and any(c.isalpha() for c in t)]
    rows = [(i, kept) for i, _, _, kept in lines(rows)]
    stay = {c for _, c, _, _ in near(rows)}
    rows = [(i, t) for i, t in rows if i in stay]
    bad = {i for i, *_, flag in contaminated(rows, items) if flag}
    want = {i: sha256(t.encode()).hexdigest() for i, t in rows if i not in bad}
    out = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"]: r["text_sha256"] for r in out} == want
    assert all((r["n_pieces"] > 0) == bool(pretokens(dict(rows)[r["doc_id"]])) for r in out)


def test_stages_take_odd_rows(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(None, None, None, "s", 1), (1, "", "en", "s", 2), (2, "12 !", None, None, None), (3, "Some text here", "en", "s", 3), (3, "Some text here", "en", "s", 3), (None, "other words", "en", "s", 4), (4, "some TEXT here", "xx", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, class_id int")
    for name, stage in corpus_pipeline.STAGES:
        for d in (docs, docs.limit(0)):
            out = stage(spark, d, folder)
            assert name == "encoded" or out.columns == docs.columns
            out.collect()
    kept = corpus_pipeline.near_copies(spark, docs, folder).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["1", "2", "3", "None", "None"]


def test_rows_that_share_an_id_but_not_a_text_stay(spark):
    one, two, other = "the first of two quite different texts", "another text that shares only its number", "a third text under a smaller number"
    rows = [(7, one), (7, two), (7, one.upper()), (3, other), (7, other), (None, one)]
    out = corpus_pipeline.near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert sorted((str(r["doc_id"]), r["text"].lower()) for r in out) == sorted([("7", one), ("7", two), ("3", other), ("None", one)])


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "lines", "near_copies", "benchmark", "encoded"]
