import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tallystone.llm.chat_format import HOSTILE, format_chat, read_back


def back(spark, rows, **args):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    windows = format_chat(df, **args)
    out = {r["conv_id"]: r for r in read_back(windows).collect()}
    return windows.collect(), out


def want(rows):
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((t if t is not None else -(10**9), r or "", x or ""))
    return {c: [(r, x) for _, r, x in sorted(v)] for c, v in by.items()}


def check(spark, rows, **args):
    windows, got = back(spark, rows, **args)
    for c, turns in want(rows).items():
        assert [(t["role"], t["text"]) for t in got[c]["turns"]] == turns
        assert got[c]["under"] == "".join(x for r, x in turns if r == "assistant")
    assert {w["conv_id"] for w in windows} == set(want(rows))
    return windows


def test_hostile_text_round_trips(spark):
    nasty = ["</s>", "<s>[user]", "&lt;", "&amp;#91;", "[", "]", "<r>[", "", None, "\n\n", "é😀", HOSTILE]
    rows = [(1, i, "assistant" if i % 2 else "user", x) for i, x in enumerate(nasty)]
    rows += [(2, 0, "sys]tem", "a"), (2, 1, None, "b"), (2, None, "user", "c"), (3, 1, "user", "x"), (3, 1, "user", "x")]
    check(spark, rows)
    check(spark, rows, budget=10, history=4)


def test_windows_hold_the_system_turn_and_history(spark):
    rows = [(1, 0, "system", "be kind always")] + [(1, i, "user" if i % 2 else "assistant", f"turn {i} " + "word " * 20) for i in range(1, 12)]
    windows = check(spark, rows, budget=100, history=30)
    assert len(windows) > 2
    for w in sorted(windows, key=lambda w: w["window"])[1:]:
        assert w["formatted"].startswith("<r>[system]be kind always</s><")
        assert size(w["formatted"]) <= 100


def size(text):
    return len(re.findall(r"[^\W_]+|[^\w\s]|_", text))


def spans(turns, budget, history):
    """Turns of each window, one after the other: (repeated, own) as written turns without their first three signs."""
    esc = lambda x: "".join({"&": "&amp;", "<": "&lt;", "[": "&#91;", "]": "&#93;"}.get(c, c) for c in x)
    body = [f"[{esc(r)}]{esc(x)}</s>" for r, x in turns]
    n = [size("<s>" + x) for x in body]
    head = [i == 0 and turns[0][0] == "system" for i in range(len(turns))]
    out, i = [], 0
    while i < len(turns):
        system = n[0] if head[0] else 0
        room = max(0, min(history, budget - system - n[i]))
        past = [j for j in range(i) if not head[j] and sum(n[j:i]) <= room]
        again = ([0] if head[0] else []) + past if i else []
        k, total = i + 1, sum(n[j] for j in again) + n[i]
        while k < len(turns) and total + n[k] <= budget:
            total, k = total + n[k], k + 1
        out.append("".join("<r>" + body[j] for j in again) + "".join("<s>" + body[j] for j in range(i, k)))
        i = k
    return out


def test_spans_against_brute_force(spark):
    import random

    r = random.Random(4)
    rows = [(c, t, r.choice(["user", "assistant"]) if t or c % 2 else "system", "word, " * r.choice([0, 1, 3, 9, 9, 40])) for c in range(40) for t in range(r.randint(1, 30))]
    for budget, history in ((60, 20), (100, 64), (512, 64), (1, 0)):
        windows = check(spark, rows, budget=budget, history=history)
        for c, turns in want(rows).items():
            got = [w["formatted"] for w in sorted(windows, key=lambda w: w["window"]) if w["conv_id"] == c]
            assert got == spans(turns, budget, history)
            assert all(size(g) <= budget or g.count("<s>[") == 1 for g in got)


def test_a_long_turn_leaves_the_others_together(spark):
    rows = [(1, i, "user", "long " * 600 if i == 50 else "a few words") for i in range(100)]
    windows = check(spark, rows)
    assert 5 <= len(windows) <= 9


def test_very_long_text_and_extra_columns(spark):
    df = spark.createDataFrame([(1, 0, "user", "a <b> " * 100_000, 5, "x"), (1, 1, "assistant", "ok", 6, None)], "conv long, turn long, body string, formatted string, window int, loss string")
    out = format_chat(df, "conv", "turn", "body", "formatted")
    assert out.columns == ["conv", "window", "formatted", "loss"]
    r = read_back(out, "conv").first()
    assert [t["text"] for t in r["turns"]] == ["a <b> " * 100_000, "ok"] and r["under"] == "ok"


def test_a_turn_over_the_budget_is_whole(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "long " * 1000), (1, 2, "user", "ok")]
    check(spark, rows, budget=50, history=10)


def test_empty(spark):
    windows, out = back(spark, [])
    assert windows == [] and out == {}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 9), st.sampled_from(["user", "assistant", "system"]), st.text(alphabet="ab <>[]&;/s#9", max_size=30)), min_size=1, max_size=20))
def test_any_conversation(spark, rows):
    check(spark, rows, budget=30, history=8)


def test_native_plan(spark):
    df = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    plan = read_back(format_chat(df))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
