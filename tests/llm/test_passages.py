"""Repeated passages of over 50 words go from op3 and the pipeline, whichever lines surround them."""

import random

import corpus_pipeline
from geoloom.llm import line_dedup


def say(rng, n):
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))


def test_planted_passages_go(spark):
    rng = random.Random(21)
    rows, wanted = [], []
    for n in (1, 2, 3, 4, 5, 9, 60):
        for _ in range(5):
            passage = [say(rng, -(-55 // n)) for _ in range(n)]
            for place in range(3):
                above, below = [say(rng, rng.randint(1, 40)) for _ in range(rng.randint(0, 3))], [say(rng, rng.randint(1, 40)) for _ in range(rng.randint(0, 3))]
                inside = passage if place < 2 else [x for line in passage for x in (line, "")][:-1]
                rows.append((len(rows), "\n".join([*above, *inside, *below])))
                wanted.append((rows[-1][0], "\n".join([*above, *(inside if place == 0 else ()), *below])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.text for r in corpus_pipeline.without_repeated_passages(spark, docs, "").collect()}
    assert found == dict(wanted)
    removed = {r.doc_id: (r.n_removed, r.kept_sha256) for r in line_dedup.report(docs).collect()}
    assert all(removed[i] == (len(rows[i][1].split("\n")) - (len(t.split("\n")) if t else 0), line_dedup.sha256(t)) for i, t in wanted if t)


def test_passages_within_a_document_and_short_ones(spark):
    rng = random.Random(22)
    a, b, short = say(rng, 30), say(rng, 60), say(rng, 50)
    rows = [(1, "\n".join([a] * 5)), (2, f"{b}\nx\n{b}"), (3, f"{short}\ny"), (4, f"z\n{short}"), (5, f"u\n{a}\n{a}\nv")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.text for r in line_dedup.deduplicated(docs, words=50).collect()}
    assert found == {1: f"{a}\n{a}", 2: f"{b}\nx", 3: f"{short}\ny", 4: f"z\n{short}", 5: "u\nv"}


def test_windows():
    lines = [b"a b", b"", b"c", b"d e f", b" ", b"g"]
    assert line_dedup.window_bounds(lines, 2) == [(0, 3), (2, 4), (3, 4), (3, 6)]
    assert line_dedup.window_bounds([b"a"] * 3, 9) == [] and line_dedup.window_bounds([], 9) == []
