"""The pipeline against a brute-force version of each stage, and every registered text query over the smallest tables."""

import hashlib
import os
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from geoloom.llm import bpe, compression_quality, line_dedup, mixing, queries
from tests.llm.test_simhash_similar import brute_kept

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("no test tables here")
    return SF


def test_pipeline(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    docs = [r.asDict() for r in table.collect()]
    model = compression_quality.fit(table, spark.read.parquet(f"{sf}/labels.parquet"), learn_from=compression_quality.learnable())
    score = {r.row: r.score for r in compression_quality.scores(table, model).collect()}
    docs = [d for d in docs if score[d["doc_id"]] >= 0.7]

    places = defaultdict(set)
    for d in docs:
        for a, b, piece in line_dedup.pieces(d["text"].encode().split(b"\n"), 50):
            places[piece].add((d["doc_id"], a, b))
    gone = defaultdict(set)
    for at in places.values():
        first = min(at)
        for i, a, b in at:
            if (i, a) != first[:2] and not (i == first[0] and a < first[2]):
                gone[i].update(range(a, b))
    for d in docs:
        d["text"] = b"\n".join(x for k, x in enumerate(d["text"].encode().split(b"\n")) if k not in gone[d["doc_id"]]).decode()

    kept = set(brute_kept([(d["doc_id"], d["text"]) for d in docs]))
    docs = [d for d in docs if d["doc_id"] in kept]

    sizes = Counter()
    for d in docs:
        sizes[d["source"]] += len(d["text"].split())
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(sorted(sizes))}
    stopped: set = set()
    while True:
        level = (sum(sizes.values()) - sum(3 * sizes[s] for s in stopped)) / sum(w for s, w in weight.items() if s not in stopped)
        more = {s for s in sizes if s not in stopped and level * weight[s] > 3 * sizes[s]}
        if not more:
            break
        stopped |= more
    coder = bpe.Coder(bpe.tokenizer_path())
    wanted = Counter()
    drawn = lambda x: int(hashlib.md5(f"{mixing.SEED}:{x}".encode()).hexdigest()[:13], 16) / 2**52
    place = Counter()
    for d in sorted(docs, key=lambda d: (-len(d["text"].split()), drawn(d["doc_id"]), d["doc_id"])):
        rate = 3.0 if d["source"] in stopped else level * weight[d["source"]] / sizes[d["source"]]
        u = drawn(d["doc_id"])
        if len(d["text"].split()) * mixing.HEAVY > sizes[d["source"]]:
            place[d["source"]] += 1
            u = (drawn("source:" + d["source"]) + place[d["source"]] * (rate - int(rate))) % 1
        ids = coder.exact.encode(d["text"], add_special_tokens=False).ids
        copies = int(rate) + (u < rate - int(rate))
        if copies:
            wanted[d["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()] += copies
    found = Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, sf).collect())
    assert found == wanted


def test_stages_keep_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(50)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.dtypes == docs.dtypes


def test_pipeline_with_nulls_empties_and_clashing_columns(spark, sf, tmp_path):
    long = " ".join(f"word{i}" for i in range(30_000))
    rows = [(None, "no id at all", "a"), (1, None, "a"), (2, "", None), (3, " \n ", "b"), (4, long, "b"), (4, long, "b"), (5, "short", None), (6, "short", "a")]
    extra = "doc_id long, text string, source string, mix string, key string, score double, size long, lang string"
    table = spark.createDataFrame([(*r, "m", "k", 0.5, 9, "en") for r in rows], extra)
    table.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.dtypes == docs.dtypes and out.count() > 0
    near = corpus_pipeline.one_of_each_group(spark, docs, "").collect()
    assert sorted(r.doc_id or 0 for r in near) == [0, 1, 4, 5]
    assert corpus_pipeline.run(spark, str(tmp_path)).columns[:2] == ["doc_id", "n_tokens"]
    table.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_registered(spark):
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {x.split("_")[0] for x in names} and "pipeline" in names
    assert set(queries.ORACLES) <= set(queries.QUERIES)
