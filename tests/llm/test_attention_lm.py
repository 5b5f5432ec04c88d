import math
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from tallystone.llm import attention_lm
from tallystone.llm.attention_lm import BEGIN, CHUNK, DIM, EACH, PARTS, SHARE, SLOTS, STRIDE, VOCAB, Learner, Scorer, _pack, _trainer, classes_of, flat, score_texts, shared, start, train, windows_of
from tallystone.llm.token_counts import MODEL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def base(rows):
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    c = Counter()
    for i, t in rows:
        if not held(i):
            c.update([*tokens(t), None])
    n, v = sum(c.values()), len(c)
    out = []
    for i, t in rows:
        w = [*tokens(t), None]
        out.append((i, held(i), len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)))
    return out


def run(spark, rows, **args):
    return score_texts(spark.createDataFrame(rows, "doc_id long, text string"), **args).collect()


ROWS = [(i, f"the Cat {i % 7} sat on\tthe mat number{i % 11}\nand slept " + "well " * (i % 60)) for i in range(60)]
ROWS += [(60, None), (61, ""), (62, " \t\n"), (63, "x\x00y É"), (None, "a null id"), (5, ROWS[5][1]), (70, "long text of words " * 3000)]


def test_base_score_against_brute_force(spark):
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    want, got = sorted(base(ROWS), key=key), sorted(map(tuple, run(spark, ROWS)), key=key)
    for a, b in zip(want, got, strict=True):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], rel=1e-9)
        assert b[6] < 0 and math.isfinite(b[6])
    again = sorted(map(tuple, run(spark, ROWS, chunk=100)), key=key)
    for a, b in zip(got, again, strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)


def test_empty_table_and_no_training(spark):
    assert run(spark, []) == []
    r = run(spark, [(next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0), "a b")])[0]
    assert r["held_out"] and r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == pytest.approx(0)


def test_other_columns_do_not_clash(spark):
    df = spark.createDataFrame([(1, "a b", 7, "x", None)], "key long, h string, n_tokens int, score string, base_score double")
    out = score_texts(df, "key", "h")
    assert out.columns == ["key", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert out.first()["n_tokens"] == 3


def softmax_log(o, y):
    return o[y] - o.max() - np.log(np.exp(o - o.max()).sum())


def plain_score(p, counts, ids):
    """One id at a time, each with its own softmax over its window."""
    p = {k: v.astype(float) for k, v in p.items()}
    (of, within), slot = classes_of(counts), shared(counts, SLOTS)
    wq, wk, wv = np.split(p["qkv"], 3, axis=1)
    x = [BEGIN, *ids[:-1]]
    e = lambda i: p["slot"][slot[i]]
    total = 0.0
    for t, y in enumerate(ids):
        first = max(0, (t // STRIDE - 1) * STRIDE)
        s = np.array([e(x[t]) @ wq @ (e(x[j]) @ wk) / DIM**0.5 + p["near"][t - j] for j in range(first, t + 1)])
        a = np.exp(s - s.max())
        h = e(x[t]) + (a / a.sum()) @ np.array([e(x[j]) @ wv for j in range(first, t + 1)])
        h = h + np.maximum(h @ p["w1"], 0) @ p["w2"]
        band, each = divmod(int(of[y]), EACH)
        u = np.maximum(h @ p["w3"] + p["band"][band], 0)
        total += softmax_log(h @ p["out"][:-1] + p["out"][-1], band) + softmax_log(u @ p["each"][:-1] + p["each"][-1], each) + within[y]
    return total / np.log(10)


def noisy(scale, seed=0):
    r = np.random.default_rng(seed)
    return {k: v + (r.standard_normal(v.shape) * scale).astype(np.float32) for k, v in start().items()}


@pytest.mark.parametrize("scale", [0.3, 3.0])  # with the larger, logits go beyond what exp can take
def test_batched_windows_against_one_at_a_time(scale):
    r = np.random.default_rng(0)
    counts, p = r.integers(0, 50, VOCAB), noisy(scale)
    docs = [r.integers(0, VOCAB, n) for n in (1, 16, 17, 50, 3, 33)]
    offs = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    for batch in (1, 3, 1000):
        got = Scorer(p, counts).log10(np.concatenate(docs), offs, batch)
        for g, d in zip(got, docs, strict=True):
            assert g == pytest.approx(plain_score(p, counts, d.tolist()), rel=1e-3 if scale > 1 else 1e-4)


def test_probabilities_sum_to_one():
    s = Scorer(start(), np.arange(VOCAB) % 97)
    context = [5, 9, 77]
    before = s.log10(np.array(context), np.array([0, 3]))[0]
    each = np.concatenate([[*context, i] for i in range(VOCAB)])
    after = s.log10(each, np.arange(0, 4 * VOCAB + 1, 4))
    assert np.sum(10 ** (after - before)) == pytest.approx(1, rel=1e-3)


def test_gradient_against_differences():
    """The learner's gradient is that of the mean loss, which the scorer gives for whole documents."""
    r = np.random.default_rng(3)
    counts, p = r.integers(0, 50, VOCAB), noisy(0.3, 4)
    ids = r.integers(0, VOCAB, 40)
    w = windows_of(ids, np.array([0, 40]))
    learner = Learner(shared(counts, SLOTS), classes_of(counts)[0], p)
    before = learner.x.astype(float)
    learner.learn(w)
    loss = lambda x: -(plain_score(attention_lm.views(x), counts, ids.tolist()) * np.log(10) - classes_of(counts)[1][ids].sum()) / 40
    g = attention_lm.views(learner.g)
    at = 0
    for k, shape in attention_lm.SHAPES.items():
        size = int(np.prod(shape))
        hot = np.argsort(-np.abs(g[k].ravel()))[[0, 1, 7]] if size > 8 else [0]
        for i in hot:
            x, h = before.copy(), 1e-4
            x[at + i] += h
            up = loss(x)
            x[at + i] -= 2 * h
            assert g[k].ravel()[i] == pytest.approx((up - loss(x)) / (2 * h), rel=2e-2, abs=1e-5), k
        at += size


def test_training_learns_a_pattern():
    r = np.random.default_rng(1)
    ids = np.array([100, 200, 300, 400, 500, 600])
    start_at = r.integers(0, 6, 400)
    windows = ids[(start_at[:, None] + np.arange(2 * STRIDE + 1)) % 6]
    counts = np.bincount(windows.ravel(), minlength=VOCAB)
    doc = ids[np.arange(64) % 6]
    untrained = Scorer(start(), counts).log10(doc, np.array([0, 64]))[0]
    trained = Scorer(train(windows, counts, start()), counts).log10(doc, np.array([0, 64]))[0]
    assert trained > untrained / 3


def test_words_that_a_polynomial_hash_confuses(spark):
    from .test_jaccard_forest import twins

    a, b = twins()
    train_id, held_id = (next(i for i in range(100) if (zlib.crc32(str(i).encode()) % 10 == 0) == held) for held in (False, True))
    r = {x["doc_id"]: x for x in run(spark, [(train_id, a), (held_id, b)])}
    assert (r[train_id]["n_known"], r[held_id]["n_known"]) == (2, 1)


def test_held_out_beats_the_unigram_of_its_own_ids(spark):
    import sentencepiece

    from tallystone.llm.token_counts import MODEL

    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    out = {r["doc_id"]: r for r in score_texts(rows).collect()}
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    counts, asked = np.full(VOCAB, 0.5), []
    for r in rows.collect():
        ids = [i for w in sp.encode(tokens(r["text"])) for i in w] + [2]
        if out[r["doc_id"]]["held_out"]:
            asked.append((r["doc_id"], ids))
        else:
            np.add.at(counts, ids, 1)
    assert len(asked) > 50
    log = np.log10(counts / counts.sum())
    unigram = sum(log[ids].sum() for _, ids in asked)
    assert sum(out[i]["score"] for i, _ in asked) > 0.9 * unigram


def test_windows_hold_every_id_once():
    r = np.random.default_rng(2)
    docs = [r.integers(3, VOCAB, n).tolist() for n in (1, 15, 16, 17, 50, 32, 1000)]
    w = windows_of(np.concatenate(docs), np.concatenate([[0], np.cumsum([len(d) for d in docs])]))
    assert len(w) == sum(-(-len(d) // STRIDE) for d in docs)
    late = w[:, STRIDE + 1 :]
    assert late[late >= 0].tolist() == [i for d in docs for i in d]
    padded = [([-1] * STRIDE + [BEGIN] + d + [-1] * STRIDE)[k * STRIDE :][: 2 * STRIDE + 1] for d in docs for k in range(-(-len(d) // STRIDE))]
    assert w.tolist() == padded


def test_training_takes_every_window_of_every_training_document(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = [(i, t, i != 70) for i, t in ROWS if i is not None] + [(71, "few long texts " * 20_000, True)]
    want = sum(-(-(sum(map(len, sp.encode(tokens(t)))) + 1) // STRIDE) for _, t, train in rows if train)
    packed = spark.createDataFrame(rows, "id long, text string, train boolean").coalesce(2).mapInArrow(_pack(spark.sparkContext.broadcast(Path(MODEL).read_bytes()), CHUNK), "kind string, chunk long, h long, n long, at int, body binary")
    model = spark.sparkContext.broadcast((np.ones(VOCAB, np.int64), flat(start())))
    for share in (50, 10**9):
        got = packed.filter("kind = 'chunk'").select("body").mapInArrow(_trainer(model, share, 64), "task int, n long, p binary").collect()
        assert sum(r["n"] for r in got) == want > 3000


def learned(spark, monkeypatch, n_docs, share):
    """Windows learned from in all, and steps of each learner that had any."""
    rows = [(i, f"words of text {i} " * 40, True) for i in range(n_docs)]
    packed = spark.createDataFrame(rows, "id long, text string, train boolean").coalesce(1).mapInArrow(_pack(spark.sparkContext.broadcast(Path(MODEL).read_bytes()), CHUNK), "kind string, chunk long, h long, n long, at int, body binary")
    body = [r["body"] for r in packed.filter("kind = 'chunk'").collect()]
    monkeypatch.setattr(attention_lm, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda _: 0})())}))
    made = []

    class Counted(Learner):
        def __init__(self, *args):
            super().__init__(*args)
            self.had = 0
            made.append(self)

        def learn(self, w):
            super().learn(w)
            self.had += len(w)

    monkeypatch.setattr(attention_lm, "Learner", Counted)
    model = type("B", (), {"value": (np.ones(VOCAB, np.int64), flat(start()))})
    for part in range(PARTS):
        list(_trainer(model, share, 16, part, PARTS)([pa.RecordBatch.from_arrays([pa.array(body, pa.binary())], ["body"])]))
    windows = sum(len(windows_of(ids, offs)) for b in body for _, _, _, ids, offs in attention_lm._runs(*attention_lm._read(b)[2:6]))
    return windows, [x.had for x in made if x.had]


def test_the_pass_is_one_at_every_size(spark, monkeypatch):
    for n_docs in (3, 300):
        windows, had = learned(spark, monkeypatch, n_docs, 500)
        assert sum(had) == windows
        assert all(n <= 500 + 16 for n in had)
    assert len(had) > PARTS and sum(n >= 500 for n in had) >= len(had) - PARTS


def test_held_out_with_trainers_that_have_their_full_share(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    got = score_texts(rows).filter("held_out").agg({"score": "sum"}).first()
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    counts, asked = np.full(VOCAB, 0.5), np.zeros(VOCAB)
    for r in rows.collect():
        held = zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0
        np.add.at(asked if held else counts, [i for w in sp.encode(tokens(r["text"])) for i in w] + [2], 1)
    assert counts.sum() > 2 * SHARE * STRIDE
    unigram = float(asked @ np.log10(counts / counts.sum()))
    assert got["sum(score)"] > 0.9 * unigram


def test_windows_that_follow_each_other_share_their_ids(monkeypatch):
    """The work on 64 such windows is that of 65 rows of ids, not of 128, and the gradient is that of the windows in any order."""
    r = np.random.default_rng(5)
    counts, ids = r.integers(0, 50, VOCAB), r.integers(0, VOCAB, 70 * STRIDE)
    w = windows_of(ids, np.array([0, len(ids)]))[2:66]
    rows, add = [], Learner._add

    def counted(self, x, *more):
        rows.append(len(x) - 1)
        add(self, x, *more)

    monkeypatch.setattr(Learner, "_add", counted)
    g = []
    for some in (w, w[r.permutation(64)]):
        learner = Learner(shared(counts, SLOTS), classes_of(counts)[0], noisy(0.3))
        learner.learn(some)
        g.append(learner.g)
        if some is w:
            assert sum(rows) == 64
    assert np.abs(g[0]).max() > 0.01
    assert g[0] == pytest.approx(g[1], abs=1e-5)


def test_a_chunk_has_one_row_of_words_a_range_of_hashes(spark):
    rows = [(i, f"word{i} and word{i + 1} of {i % 10}", True) for i in range(2000)]
    packed = spark.createDataFrame(rows, "id long, text string, train boolean").coalesce(1).mapInArrow(_pack(spark.sparkContext.broadcast(Path(MODEL).read_bytes()), CHUNK, 8), "kind string, chunk long, h long, n long, at int, body binary")
    got = packed.filter("kind = 'word'").select("h", "n").collect()
    assert sorted(r["h"] for r in got) == list(range(8))
    assert sum(r["n"] for r in got) == len({w for _, text, _ in rows for w in tokens(text)})
