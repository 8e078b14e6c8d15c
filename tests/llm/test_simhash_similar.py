"""The pipeline's near-duplicates against brute-force Jaccard pairs."""

import random

import pytest

import corpus_pipeline
from geoloom.llm import simhash_similar


def brute_kept(rows):
    """Ids that stay when all pairs with a Jaccard of 0.8 or more over five-word shingles are linked."""
    words = [(i, (t or "").lower().split()) for i, t in rows]
    sets = [(i, {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}) for i, w in words]
    root = {i: i for i, _ in sets}
    for a, x in sets:
        for b, y in sets:
            if a < b and root[a] != root[b] and 5 * len(x & y) >= 4 * len(x | y):
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {k: new if r == old else r for k, r in root.items()}
    return sorted(i for i, r in root.items() if i == r)


def test_near_duplicates_by_jaccard(spark):
    rng = random.Random(12)
    say = lambda n: [f"w{rng.randrange(4000)}" for _ in range(n)]
    rows = [(0, None), (1, " \n"), (2, "two words"), (3, "Two  words"), (4, "two others")]
    for _ in range(40):
        base = say(rng.randint(80, 300))
        rows.append((len(rows), " ".join(base)))
        for k in range(6):
            # Each replaced word changes five shingles: similarities from about 0.6 to 1; some follow from copy to copy.
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                copy[rng.randrange(len(copy))] = "new"
            rows.append((len(rows), " ".join(copy)))
            base = copy if k % 2 else base
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    out = corpus_pipeline.one_of_each_group(spark, docs.unionAll(spark.createDataFrame([(None, "two words", "en")], docs.schema)), "")
    assert out.dtypes == docs.dtypes
    wanted = brute_kept(rows)
    assert 40 < len(wanted) < len(rows) - 40
    assert sorted(r.doc_id for r in out.collect() if r.doc_id is not None) == wanted
    assert out.where("doc_id is null").count() == 1


@pytest.mark.parametrize("tile", [1000, 20])
def test_a_group_that_its_least_does_not_hold(spark, monkeypatch, tile):
    """Copies that drift from a common text: many are unlike the least of their buckets, and linked through others."""
    monkeypatch.setattr(simhash_similar, "LEAST_TILE", 4)
    rng = random.Random(13)
    base = [f"w{rng.randrange(4000)}" for _ in range(90)]
    rows = []
    for i in range(220):
        copy = list(base)
        for k in rng.sample(range(90), rng.choice((0, 1, 2, 3, 4))):
            copy[k] = f"new{rng.randrange(40)}"
        rows.append((i, " ".join(copy)))
    rows[0] = (0, " ".join(base[:20] + ["other"] * 2 + base[20:60] + ["more"] * 2 + base[60:]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = simhash_similar.representatives(docs, tile=tile)
    assert sorted(r.doc_id for r in found.collect()) == brute_kept(rows)


def test_near_duplicates_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert corpus_pipeline.one_of_each_group(spark, docs, "").collect() == []
