"""op11 to op13 against brute-force versions, with nulls, empties, ties, repeated rows, empty tables and clashing names."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from geoloom.llm import clustering, compression_quality, language_id, merkle

EXTRA = "doc_id long, text string, lang string, source string, n_chars long, row long, digest string"


def spoken(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n)).capitalize() + "."


VOICES = {
    "da": "ikke og det er jeg på dig med hvad skal være også nogen bliver efter hvordan kommer siger".split(),
    "no": "ikke og det er jeg på deg med hva skal være også noen blir etter hvordan kommer sier".split(),
    "it": "che non di la il sono per una con questo come anche della perché molto essere quando".split(),
    "pt": "que não de a o são por uma com este como também da porque muito ser quando você".split(),
}


def spoken_rows(each=60):
    rng = random.Random(11)
    rows = [(i * len(VOICES) + k, spoken(rng, words, rng.randint(8, 60)), lang) for i in range(each) for k, (lang, words) in enumerate(VOICES.items())]
    return [(i, t, x, "s", len(t), 1, "clash") for i, t, x in rows]


def brute_vector(text):
    """Counts of letter runs, place by place, in plain Python."""
    cells = [ord(c) if c.isalpha() else 0 for c in text.lower()]
    edged = [0, *cells, 0]
    kept = [c for i, c in enumerate(edged) if i == 0 or c or edged[i - 1]]
    counts = Counter()
    for n in (1, 2, 3):
        for i in range(len(kept) - n + 1):
            h = n * 0x27D4EB2F & 0xFFFFFFFF
            for c in kept[i : i + n]:
                h = ((h ^ c) * 0x85EBCA6B) & 0xFFFFFFFF
                h ^= h >> 15
            counts[h % language_id.PLACES] += 1
    out = np.zeros(language_id.PLACES)
    for place, n in counts.items():
        out[place] = math.sqrt(n / sum(counts.values()))
    return out


def brute_language(model, text):
    """The two steps of one text, pair by pair."""
    if text is None or not any(c.isalpha() for c in text):
        return "und", 0.0
    v = brute_vector(text)

    def best(choice):
        points = [0.0] * choice.count
        for at, (i, j) in enumerate(choice.pairs):
            w, (a, b) = choice.weights[:, at].astype(float), choice.curves[at]
            p = 1 / (1 + math.exp(-min(30, max(-30, a + b * (float(v @ w[:-1]) + w[-1])))))
            points[i] += p / len(choice.pairs)
            points[j] += (1 - p) / len(choice.pairs)
        at = max(range(choice.count), key=lambda k: (points[k], -k)) if choice.pairs else 0
        return at, points[at] if choice.pairs else 1.0

    f, p = best(model.between)
    k, q = best(model.within[f])
    return model.languages[model.families[f][k]], p * q


def test_languages_by_families(spark):
    rows = spoken_rows()
    odd = [(9001, None, "da", None, 0, 1, ""), (9002, "", None, None, 0, 1, ""), (9003, "123 456 !?", "it", "s", 0, 1, ""), (None, "ikke og det er", "da", "s", 0, 1, ""), (9004, "non di la " * 150_000, None, "s", 0, 1, ""), (9004, "não você também", None, "s", 0, 1, ""), (9004, "não você também", None, "s", 0, 1, "")]
    docs = spark.createDataFrame(rows + odd, EXTRA)
    model = language_id.fit(docs, learn_from=compression_quality.learnable())
    assert model.languages == ["da", "it", "no", "pt"]
    assert model.families == [[0, 2], [1, 3]]
    found = language_id.predictions(docs, model).collect()
    assert len(found) == len(rows) + len(odd)
    wanted = defaultdict(list)
    for r in rows + odd:
        wanted[r[0]].append(brute_language(model, r[1]))
    got = defaultdict(list)
    for r in found:
        assert 0 <= r.score <= 1
        got[r.row].append((r.lang_pred, r.score))
    for i, w in wanted.items():
        assert [x for x, _ in sorted(got[i])] == [x for x, _ in sorted(w)]
        assert np.allclose([s for _, s in sorted(got[i])], [s for _, s in sorted(w)], atol=1e-4)
    truth = {r[0]: r[2] for r in rows}
    held_out = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held_out) > 30
    assert sum(got[i][0][0] == truth[i] for i in held_out) / len(held_out) > 0.95


def test_languages_learn_nothing_from_the_held_out(spark):
    """Wrong languages on held-out rows change no prediction."""
    rows = spoken_rows(20)
    changed = [(r[0], r[1], "xx", *r[3:]) if zlib.crc32(str(r[0]).encode()) % 4 == 2 else r for r in rows]
    got = []
    for x in (rows, changed):
        docs = spark.createDataFrame(x, EXTRA)
        got.append(sorted(map(tuple, language_id.predictions(docs, language_id.fit(docs, learn_from=compression_quality.learnable())).collect())))
    assert got[0] == got[1]


def test_languages_of_small_tables(spark):
    empty = spark.createDataFrame([], EXTRA)
    model = language_id.fit(empty)
    assert language_id.predictions(empty, model).collect() == []
    one = spark.createDataFrame([(1, "det er", "da", "s", 6, 1, ""), (2, "og jeg", "da", "s", 6, 1, ""), (3, "hva", None, "s", 3, 1, "")], EXTRA)
    assert {r.lang_pred for r in language_id.predictions(one, model).collect()} == {"und"}
    assert {(r.lang_pred, r.score) for r in language_id.predictions(one, language_id.fit(one)).collect()} == {("da", 1.0)}


def test_families_join_the_nearest():
    means = np.array([[1, 0.1, 0], [0, 1, 0.1], [1, 0.2, 0], [0, 1, 0.2]])
    assert language_id.families(means) == [[0, 2], [1, 3]]
    assert language_id.families(means[:1]) == [[0]]


def brute_clusters(rows):
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    place = lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    c = [v for _, v in sorted(kept, key=place)[:8]]
    distance = lambda v, w: sum((a - b) ** 2 for a, b in zip(v, w, strict=True))
    nearest = lambda v: min(range(len(c)), key=lambda k: (distance(v, c[k]), k))
    for _ in range(10):
        of = defaultdict(list)
        for _, v in kept:
            of[nearest(v)].append(v)
        c = [[sum(x) // len(of[k]) for x in zip(*of[k], strict=True)] if k in of else c[k] for k in range(len(c))]
    last = [(i, nearest(v), distance(v, c[nearest(v)])) for i, v in kept]
    inertia = Counter()
    for _, k, d in last:
        inertia[k] += d
    long = lambda v: v if v < 2**63 else None
    return [(i, k, long(d), long(inertia[k]), long(sum(inertia.values())), hashlib.sha256(",".join(map(str, c[k])).encode()).hexdigest()) for i, k, d in last]


VECTORS = "vec_id long, embedding array<double>, label int, cluster string, x string"


def vector_rows(kind):
    rng = random.Random(kind)
    if kind == "ties":
        # Whole steps on a grid: many vectors lie as far from one centroid as from another.
        return [(i, [float(rng.randint(-1, 1)) if k < 3 else 0.0 for k in range(64)]) for i in range(400)]
    if kind == "huge":
        return [(i, [rng.choice([-1, 1]) * 10.0 ** rng.randint(0, 6) for _ in range(64)]) for i in range(60)]
    centers = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(12)]
    rows = [(i, [c + rng.gauss(0, 0.4) for c in rng.choice(centers)]) for i in range(500)]
    rows += [(7, rows[3][1]), (7, rows[3][1]), (None, rows[9][1]), (1000, None), (1001, []), (1002, [1.0] * 63), (1003, [1.0] * 65)]
    rows += [(1004, [1.0] * 63 + [None]), (1005, [1.0] * 63 + [float("nan")]), (1006, [1.0] * 63 + [float("inf")]), (1007, [0.0] * 64)]
    return rows


@pytest.mark.parametrize("kind", ["groups", "ties", "huge"])
def test_clusters_equal_plain_rounds(spark, kind):
    rows = vector_rows(kind)
    table = spark.createDataFrame([(i, v, 1, "clash", "y") for i, v in rows], VECTORS).repartition(3)
    order = lambda r: (r[0] is None, r)
    assert sorted((tuple(r) for r in clustering.clustered(table).collect()), key=order) == sorted(brute_clusters(rows), key=order)


def test_clusters_of_few_vectors(spark):
    assert clustering.clustered(spark.createDataFrame([], VECTORS)).collect() == []
    rows = [(i, [float(i)] * 64) for i in range(3)]
    found = clustering.clustered(spark.createDataFrame([(i, v, 1, "", "") for i, v in rows], VECTORS)).collect()
    assert sorted(map(tuple, found)) == sorted(brute_clusters(rows))


def test_sums_beyond_a_long_are_null(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1e12, 1e12]) for _ in range(64)]) for i in range(30)]
    found = clustering.clustered(spark.createDataFrame([(i, v, 1, "", "") for i, v in rows], VECTORS)).collect()
    assert None in {r.distance for r in found}
    wanted = {r[0]: r for r in brute_clusters(rows)}
    for r in found:
        assert (r.vec_id, r.cluster, r.distance, r.centroid_sha256) == (*wanted[r.vec_id][:3], wanted[r.vec_id][5])
        assert r.inertia is None


def test_bounds_spare_most_comparisons():
    rng = np.random.default_rng(3)
    centers = rng.integers(-3000, 3000, (8, 64))
    x = np.vstack([c + rng.integers(-200, 200, (200, 64)) for c in centers])
    before = [c.tolist() for c in centers + rng.integers(-30, 30, (8, 64))]
    cluster, upper, lower, n = clustering.Moves(before, None).assign(x, np.zeros(len(x), dtype=np.int32), np.zeros(len(x)), np.zeros(len(x)))
    assert n == len(x)
    after, _, _, n = clustering.Moves(centers.tolist(), before).assign(x, cluster, upper, lower)
    assert n < len(x) / 20
    assert (after == clustering.scanned(x, np.array(centers))[0]).all()


def brute_manifest(rows):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: sha(field(r[0]) + field(r[3]) + field(r[2]) + field(r[4]) + field(text))

    def levels(digests):
        out = [digests]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
        return out

    def runs(tree, i):
        for level in tree[:-1]:
            start = i // 3 * 3
            yield level[start : start + 3], i - start
            i //= 3

    by = defaultdict(list)
    for r in rows:
        by[r[3]].append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in sources:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
    trees = {s: levels([leaf(r, r[1]) for r in by[s]]) for s in sources}
    top = levels([trees[s][-1][0] for s in sources])
    for at, s in enumerate(sources):
        for i, r in enumerate(by[s]):
            path = [*runs(trees[s], i), *runs(top, at)]
            proof = "".join("".join(run[:k] + run[k + 1 :]) for run, k in path)
            changed = r[1] is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            h = leaf(r, r[1].replace("\n", "") if changed else r[1])
            for run, k in path:
                h = sha("".join([*run[:k], h, *run[k + 1 :]]))
            yield r[0], leaf(r, r[1]), trees[s][-1][0], top[-1][0], sha(proof), h, h == top[-1][0]


def manifest_rows():
    rng = random.Random(13)
    rows = [(i, "line\n" * rng.randint(0, 3) + f"é€ {i}", rng.choice(["en", None]), "hot", 7, 1, "") for i in range(2300)]
    rows += [(i, f"a\nb {i}", "de", f"s{k}", i, 1, "") for k in range(11) for i in range(k * 100, k * 100 + k + 1)]
    rows += [(5000, None, None, None, None, 1, ""), (5001, "", "en", "", 0, 1, ""), (None, "x\ny", "en", "s3", 3, 1, ""), (5002, "x\n" * 40_000, "en", "Z", 3, 1, "")]
    rows += [(6000, "same\n", "en", "same", 5, 1, "")] * 40 + [(6000, "other\n", "en", "same", 5, 1, "")]
    rng.shuffle(rows)
    return rows


def test_manifest_equals_plain_trees(spark):
    rows = manifest_rows()
    found = merkle.manifest(spark.createDataFrame(rows, EXTRA).repartition(5)).collect()
    order = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, found), key=order) == sorted(brute_manifest(rows), key=order)
    assert {r.verified for r in found} == {True, False}


@pytest.mark.parametrize("rows", [[], manifest_rows()[:1], [(1, "a\nb", "en", "only", 3, 1, "")] * 4])
def test_manifest_of_small_tables(spark, rows):
    found = merkle.manifest(spark.createDataFrame(rows, EXTRA)).collect()
    assert sorted(map(tuple, found)) == sorted(brute_manifest(rows))


def test_parents_wait_for_their_arity():
    """Digests in any order; a parent goes on exactly when all of its children are there."""
    rng = random.Random(2)
    for size in (1, 2, 3, 4, 9, 10, 28, 100):
        leaves = [(i, hashlib.sha256(str(i).encode()).hexdigest()) for i in range(size)]
        wanted = [d for _, d in leaves]
        while len(wanted) > 1:
            wanted = [hashlib.sha256("".join(wanted[i : i + 3]).encode()).hexdigest() for i in range(0, len(wanted), 3)]
        rng.shuffle(leaves)
        parts = [merkle.Partial(), merkle.Partial()]
        done = [node for i, d in leaves for node in parts[rng.randint(0, 1)].add("g", size, 0, i, d)]
        last = merkle.Partial()
        done += [node for p in parts for x in sorted(p.rest(), key=lambda x: x[2]) for node in last.add(*x)]
        assert not last.open
        assert [n[4] for n in done if n[5] == 1] == (wanted if size > 1 else [])
