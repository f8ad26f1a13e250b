"""The pipeline's stages, each against what brute force makes of its own input."""

import sys
from pathlib import Path

import corpus_pipeline

sys.path.insert(0, str(Path(__file__).parent))
from test_neardup import brute_classes  # noqa: E402
from test_text_operators import brute_lines, brute_windows  # noqa: E402

INSULTS = {"trash", "pathetic", "idiot", "disgusting", "worthless", "stupid", "clown", "scum", "loser", "moron"}


def test_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, stage = docs.columns, []
    for name, f in corpus_pipeline.STAGES:
        before = sorted((r.asDict() for r in docs.collect()), key=lambda r: r["doc_id"])
        f(spark, docs, sf).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        stage.append((name, before, [r.asDict() for r in docs.collect()]))
        if name != "mix":
            assert docs.columns == columns
    named = {n: (b, a) for n, b, a in stage}

    before, after = named["toxicity"]
    kept = {r["doc_id"] for r in after}
    bad = {r["doc_id"] for r in before if len(INSULTS & set(r["text"].lower().replace(".", " ").replace(",", " ").split())) >= 3}
    assert len(bad & kept) <= 0.2 * len(bad) and len(kept) >= 0.8 * len(before)

    before, after = named["lines"]
    want = {r["doc_id"]: "\n".join(k) for r, k in zip(before, brute_lines([r["text"] for r in before]), strict=True)}
    assert {r["doc_id"]: r["text"] for r in after} == want

    before, after = named["near_duplicates"]
    first = brute_classes([(r["doc_id"], r["text"]) for r in before])
    assert {r["doc_id"] for r in after} == set(first.values())

    before, after = named["decontaminate"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    clean = {r["doc_id"] for r, w in zip(before, brute_windows([r["text"] for r in before], items), strict=True) if not w[1]}
    assert {r["doc_id"] for r in after} == clean

    before, after = named["mix"]
    copies = {}
    for r in after:
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
    assert set(copies) <= {r["doc_id"] for r in before} and max(copies.values()) <= 3
    assert sorted(map(str, corpus_pipeline.run(spark, sf).collect())) == sorted(map(str, docs.collect()))


def test_run_on_awkward_and_empty_tables(spark, awkward, empty, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 1), (None, 0, 1)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "alpha beta gamma"), (None, None)], "item_id long, text string")
    for name, docs in (("a", awkward), ("e", empty)):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.limit(3 if name == "a" else 0).write.parquet(f"{tmp_path}/{name}/labels.parquet")
        bench.limit(2 if name == "a" else 0).write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
    out = corpus_pipeline.run(spark, f"{tmp_path}/a")
    rows = out.collect()
    assert out.columns == [*awkward.columns, "copy"] and corpus_pipeline.run(spark, f"{tmp_path}/e").count() == 0
    assert 1 not in {r.doc_id for r in rows} and {r.doc_id for r in rows} <= {r.doc_id for r in awkward.collect()}
    assert sum(r.text == "one two three four five six seven" and r["copy"] == 1 for r in rows) <= 1


def test_near_duplicates_do_not_depend_on_the_size_of_a_group(spark, monkeypatch):
    """The stage keeps the same documents when every centre counts as one with very many members, and nothing is dealt by hashed differences."""
    import random

    import corpus_pipeline
    from twinline.llm import neardup

    assert not hasattr(neardup, "by_difference")
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(150)]
    rows = []
    for i in range(40):
        t = list(base)
        for _ in range(rng.randrange(1, 7)):
            t[rng.randrange(150)] = word()
        rows.append((i, " ".join(t)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(r.doc_id for r in corpus_pipeline.dedup_near(spark, docs, "").collect())
    assert sorted(r.doc_id for r in neardup.keep_first(docs, limit=8, wide=8).collect()) == want and len(want) < 40


def test_near_duplicates_lose_no_link_of_a_large_group(spark):
    """Texts that only a member of the first text's class links to it are left out, be the group small or one with very many members."""
    import random

    from twinline.llm import neardup

    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(8))
    base = [word() for _ in range(304)]
    texts = [base]
    for k in range(24):  # y differs from the first text in 5 shingles of 300, x in these and 30 others
        y = list(base)
        y[20 + k] = word()
        x, at = list(y), rng.randrange(60, 80)
        for j in range(6):
            x[at + 40 * j] = word()
        texts += [y, x]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    first = brute_classes([(r.doc_id, r.text) for r in docs.collect()])
    assert set(first.values()) == {0}
    assert [r.doc_id for r in neardup.keep_first(docs, limit=8, wide=8).collect()] == [0]
    assert [r.doc_id for r in corpus_pipeline.dedup_near(spark, docs, "").collect()] == [0]
