from tallystone.llm.line_dedup import BLANK, dedup_lines, line_runs

LONG = "A line that is long enough to be taken as a key, number "


def brute(rows, min_docs=5, min_chars=40):
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANK))

    holders = {}
    for n, (i, t) in enumerate(rows):
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= min_chars:
                holders.setdefault(k, set()).add(("row", n) if i is None else ("id", i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = []
        for x in lines:
            h = holders.get(key(x), [])
            top = max((j for kind, j in h if kind == "id"), default=None)
            if len(h) < min_docs or i == top:
                kept.append(x)
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def run(spark, rows, **args):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = dedup_lines(df, **args).select("doc_id", "n_lines", "n_dropped", "kept").collect()
    return [tuple(r) for r in out]


def srt(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[3]))


def test_against_brute_force(spark):
    rows = [(i, "\n".join([f"own line {i} " + "x" * 40, LONG + str(i % 3), "short", f" {LONG.upper()}{i % 4}\t"])) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, LONG + "0\n" * 3 + LONG + "0")]
    assert srt(run(spark, rows)) == srt(brute(rows))


def test_repeats_nulls_ties(spark):
    rows = [(None, LONG + "7"), (7, LONG + "7"), (7, LONG + "7"), (3, LONG + "7"), (3, "a\n" + LONG + "7\nb"), (5, "İ" * 40 + "\n" + LONG + "7")]
    assert srt(run(spark, rows)) == srt(brute(rows))


def test_empty_and_clashing_names(spark):
    assert run(spark, []) == []
    df = spark.createDataFrame([(1, "x", 5, 6)], "doc_id long, text string, n_lines int, kept int")
    out = dedup_lines(df)
    assert out.columns == ["doc_id", "text", "n_lines", "kept", "_n_lines", "n_dropped", "_kept"]
    assert out.first()["_kept"] == "x"


def test_rows_with_one_id_are_one_document(spark):
    rows = [(i, LONG + "9") for i in (1, 1, 1, 1, 2, 3, 4)] + [(i, LONG + "8") for i in (1, 1, 1, 2, 3, 4, 5)]
    got = srt(run(spark, rows))
    assert got == srt(brute(rows)) and sum(r[2] for r in got) == 6


def runs_of(spark, monkeypatch=None):
    keys = spark.createDataFrame([(bytes([k]), 10 * b + k, b) for b in range(5) for k in range(b, b + 4)], "h binary, id long, batch int")
    return line_runs(keys, batches=5, fanout=2)


def test_runs_compact_and_hold_each_hash_once(spark):
    runs = runs_of(spark)
    assert sorted(r.level for r in runs) == [0, 2]  # 5 = 4 + 1
    held = [bytes(x["h"]) for r in runs for x in r.merged().collect()]
    assert len(held) == len(set(held)) == 8
    count = {bytes(x["h"]): (x["n"], x["id"]) for r in runs for x in r.merged().collect()}
    assert count == {bytes([k]): (len(b), max(10 * x + k for x in b)) for k in range(8) for b in [[b for b in range(5) if b <= k < b + 4]]}
    assert [x["h"] for r in runs if r.level == 0 for x in r.entries.collect()] == [bytes([7])]  # all but this were known


def test_the_anti_join_decides(spark, monkeypatch):
    """With a join that finds nothing, counts fall apart over the runs."""
    frame = type(spark.range(1))
    whole = frame.join
    monkeypatch.setattr(frame, "join", lambda a, b, on=None, how=None: whole(a, b.limit(0), on, how) if how == "left" else whole(a, b, on, how))
    assert all(x["n"] < 4 for r in runs_of(spark) for x in r.merged().collect() if bytes(x["h"]) == bytes([4]))


def test_very_long_text(spark):
    text = "\n".join(f"{LONG}{i % 50} {'y' * 30}" for i in range(20_000))
    rows = [(i, text if i == 0 else text[:6000]) for i in range(6)]
    assert srt(run(spark, rows)) == srt(brute(rows))
