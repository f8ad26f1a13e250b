"""Line dedup, decontamination, mixing and chat against the SQL that DuckDB runs, and on awkward tables."""

import hashlib
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F
from twinline.llm import chat, decontam, lines, mixing

#: The repeated lines of the awkward table.
LINES = "\n".join(f"line {i} of a passage that repeats" for i in range(4))
CASES = {
    "lines": (lines.op2_lines, lines.SQL), "mix": (mixing.op4_mix, mixing.SQL),
    "decontam": (decontam.op6_decontaminate, decontam.SQL), "chat": (chat.op10_preferences, chat.SQL),
}


@pytest.mark.parametrize("name", CASES)
def test_matches_sql(spark, sf, name):
    query, sql = CASES[name]
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    got = query(spark, sf)
    names = sorted(got.columns)
    want = con.sql(f"select {', '.join(names)} from ({sql})").fetchall()
    rows = [tuple(r[c] for c in names) for r in got.collect()]
    near = lambda x: tuple(round(v, 6) if isinstance(v, float) else v for v in x)
    assert sorted(map(repr, map(near, rows))) == sorted(map(repr, map(near, want)))


def brute_lines(texts, least=lines.LEAST, floor=lines.FLOOR):
    weigh = lambda x: max(floor, len(re.findall(r"[^\x20\x09-\x0d]+", x))) if re.search(r"[^\x20\x09-\x0d]", x) else 0
    docs, first, out = [t.split("\n") for t in texts], {}, []
    for d, ls in enumerate(docs):
        w, found = [weigh(x) for x in ls], set()
        for i in (i for i in range(len(ls)) if w[i]):
            e = next((e for e in range(i, len(ls)) if w[e] and sum(w[i : e + 1]) >= least), None)
            s = next((s for s in range(i, -1, -1) if w[s] and sum(w[s : i + 1]) >= least), None)
            found |= ({(i, e)} if e is not None else set()) | ({(s, i)} if s is not None else set())
        gone = set()
        for s, e in sorted(found):
            fd, fs = first.setdefault(tuple(ls[s : e + 1]), (d, s))
            if (fd, fs) != (d, s):
                lo, hi = s, e
                while lo and fs - (s - lo) and ls[lo - 1] == docs[fd][fs - (s - lo) - 1]:
                    lo -= 1
                while hi + 1 < len(ls) and fs + hi + 1 - s < len(docs[fd]) and ls[hi + 1] == docs[fd][fs + hi + 1 - s]:
                    hi += 1
                gone |= set(range(lo, hi + 1))
        out.append([x for i, x in enumerate(ls) if i not in gone])
    return out


@pytest.mark.parametrize(("least", "floor"), [(1, 1), (8, 4), (12, 3), (60, 6)])
def test_line_runs_by_brute_force(spark, documents, least, floor):
    rows = [(r["doc_id"], r["text"]) for r in documents]
    rows += [(10**6 + i, "\n".join(f"{'word ' * (j % 4)}{j % (3 + i)}" if j % 5 else "" for j in range(40))) for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in lines.dedup_lines(df, least, floor).collect()}
    for (d, _), kept in zip(rows, brute_lines([t for _, t in rows], least, floor), strict=True):
        assert got[d] == "\n".join(kept)


def test_matches_are_extended_both_ways(spark):
    """Blank lines are in no window: they go only because a match grows over them."""
    long = [f"{c} one two three four five six seven eight" for c in "abcd"]
    rows = [(1, "\n".join(["", long[0], "", "", long[1], "x", ""])), (2, "\n".join(["mine", "", long[0], "", "", long[1], "y", ""])), (3, "\n".join([long[2], "", long[0]])), (4, "\n\n\n"), (5, "\n\n\n"), (6, "tiny\nlines"), (7, "z\ntiny\n\nlines"), (8, "q\ntiny\nlines")]
    got = {r.doc_id: r.text for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == rows[0][1] and got[2] == "mine\ny\n" and got[3] == long[2] and got[4] == got[5] == "\n\n\n"
    assert got[6] == "tiny\nlines" and got[7] == "z\ntiny\n\nlines" and got[8] == "q"


def test_lines_awkward(spark, awkward, empty):
    assert lines.dedup_lines(empty).count() == 0
    out = lines.dedup_lines(awkward)
    assert out.columns == awkward.columns
    rows = out.collect()
    assert len(rows) == awkward.count()
    by = {r.doc_id: r for r in rows}
    assert by[8].text == LINES + "\nmine" and by[9].text == "before\nafter" and by[9].n_chars == 12
    assert by[3].text is None and by[3].n_chars is None and by[4].text == ""


def brute_windows(docs, items, size=10):
    words = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    wins = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            wins.setdefault(tuple(w[i : i + size]), set()).add("" if item is None else str(item))
    out = []
    for text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in wins}:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i : i + n])) in wins:
                    hit |= set(range(i, i + n))
                    found |= wins[k]
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("limit", [decontam.BROADCAST_ROWS, 0])
def test_decontamination_awkward(spark, awkward, empty, limit):
    items = [(1, "alpha beta gamma"), (2, None), (None, "SHARED10 shared11, shared12! " + " ".join(f"shared{i}" for i in range(13, 40))), (10, "x"), (9, ""), (10, "one two three four five six seven")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = awkward.collect()
    got = decontam.marked(awkward, bench, limit=limit).collect()
    want = Counter((r.doc_id, *w[:3]) for r, w in zip(rows, brute_windows([r.text for r in rows], items), strict=True))
    assert Counter((r.doc_id, r["__hit"].n_words, r["__hit"].n_hit, len(r["__hit"]["items"])) for r in got) == want
    assert decontam.remove_contaminated(awkward, bench.limit(0)).count() == len(rows)
    assert decontam.remove_contaminated(empty, bench).count() == 0
    assert decontam.remove_contaminated(awkward, bench).columns == awkward.columns


def test_one_window_in_very_many_items(spark):
    """A shared window of common words: items don't multiply places, and every item is reported."""
    shared = " ".join(["the", "of"] * 5)
    n = 100_000
    bench = spark.range(n).select(F.col("id").alias("item_id"), F.concat(F.lit(shared + " tail"), "id").alias("text"))
    texts = [shared + " and more", "the of " * 400, "nothing here", shared + " tail7 end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r["__hit"] for r in decontam.marked(docs, bench).collect()}
    assert [got[i].n_hit for i in range(4)] == [10, 800, 0, 11]
    assert [len(got[i]["items"]) for i in range(4)] == [n, n, 0, n]


def loop_targets(sizes, weights, cap=3):
    names = sorted([n for n in sizes if n is not None]) + [None] * (None in sizes)
    w = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        rest = [n for n in names if n not in full]
        left = total - sum(full.values())
        share = {n: left * w[n] / sum(w[m] for m in rest) for n in rest}
        over = [n for n in rest if share[n] > cap * sizes[n]]
        if not over:
            return {**full, **share}
        full |= {n: cap * sizes[n] for n in over}


def test_targets_follow_the_loop(spark):
    for sizes in ({"a": 10, "b": 1000, "c": 3, "d": 40, None: 500}, {"a": 5}, {"é": 7, "z": 7, "Z": 700, "": 1}):
        df = spark.createDataFrame(list(sizes.items()), "source string, size long")
        got = {r.source: r.target for r in mixing.source_targets(df).collect()}
        assert {k: round(v, 6) for k, v in got.items()} == {k: round(v, 6) for k, v in loop_targets(sizes, (5, 2, 1)).items()}


def test_mixing_awkward(spark, awkward, empty):
    assert mixing.mix_sources(empty).count() == 0
    for limit in (mixing.BROADCAST_SOURCES, 0):
        out = mixing.with_copies(awkward, broadcast_sources=limit)
        rows = out.collect()
        assert len(rows) == awkward.count() and all(r["__mix"].copies <= 3 for r in rows)
    taken = mixing.mix_sources(awkward)
    assert taken.columns == [*awkward.columns, "copy"] and taken.count() == sum(r["__mix"].copies for r in rows)
    assert sorted(map(str, taken.collect())) == sorted(map(str, mixing.mix_sources(awkward.repartition(5)).collect()))


def test_a_column_named_copy_stays(spark, awkward):
    taken = mixing.mix_sources(awkward.withColumn("copy", F.lit("mine")))
    assert taken.columns == [*awkward.columns, "copy", "copy_"] and {r["copy"] for r in taken.collect()} == {"mine"}


def test_each_source_comes_near_its_target(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("explode(sequence(0, 40)) as k", "doc_id * 100 as d", "text", "source").selectExpr("d + k as doc_id", "text", "source")
    got = {}
    for r in mixing.with_copies(rows).select("source", "__mix.*").collect():
        x = got.setdefault(r.source, [0, r.target, 0.0])
        part = (r.target / r.source_size) % 1
        x[0] += r.size * r.copies
        x[2] += r.size**2 * part * (1 - part)
    assert all(abs(t - want) <= 5 * var**0.5 + 1e-6 for t, want, var in got.values())


def test_preferences_by_hand(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "hello there"), (2, 0, "user", "hi"), (2, 1, "assistant", "no"), (2, 2, "user", None), (3, 0, None, "x"), (3, None, "assistant", "ab"), (None, 0, "user", "lost")]
    df = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string")
    got = {r.pair_id: r for r in chat.format_pairs(chat.preference_pairs(df)).collect()}
    assert set(got) == {1, 2, 3}
    r = got[1]
    assert (r.chosen_conv, r.rejected_conv, r.n_common) == (1, 2, 1) and r.prompt == "<|turn|>user\nhi<|end|>\n"
    assert r.chosen_completion == "<|turn|>assistant\nhello there<|end|>\n" and r.chosen_mask == "18-29"
    a, b = map(int, r.chosen_mask.split("-"))
    assert r.chosen_completion[a:b] == "hello there" and got[2].chosen_completion == r.chosen_completion
    assert got[3].n_common == 0 and got[3].rejected_completion.startswith("<|turn|>assistant\na<|end|>")
    same = spark.createDataFrame([(1, [("user", "a")], [("user", "a")])], "pair_id int, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>")
    r = chat.format_pairs(same).first()
    assert r.n_common == 1 and r.chosen_completion == "" == r.rejected_completion and r.chosen_mask == ""
    assert chat.format_pairs(chat.preference_pairs(df.limit(0))).count() == 0
