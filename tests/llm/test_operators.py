"""The text operators against brute-force versions, on small tables with nulls, empties, ties, copies and extra columns."""

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from geoloom.llm import bpe, compression_quality, embedding_dedup, html_extract, line_dedup, mixing, quality_rules, simhash, suffix_array, suffix_dedup, warc
from geoloom.llm.shared import components

DOCS = "doc_id long, text string, lang string, source string, size long, component_id string"
WORDS = "river stone bright cloud under every morning seven quiet garden letter window carry yellow spring table".split()


def frame(spark, rows):
    """Documents with extra columns whose names clash with those that operators add."""
    return spark.createDataFrame([(i, t, "en", s, 7, "x") for i, t, s in rows], DOCS)


def sample_rows():
    rng = random.Random(5)
    say = lambda n: " ".join(rng.choice(WORDS) + rng.choice("abcdefgh") for _ in range(n))
    shared = say(60)
    base = say(120)
    rows = [(0, None, "a"), (1, "", "a"), (2, "   \n\t ", None), (3, "short", "b"), (4, "two words", "b")]
    rows += [(10 + i, base, "a") for i in range(4)]
    rows += [(20 + i, base.replace(base.split()[50 + i], "changed", 1), "a") for i in range(4)]
    rows += [(30 + i, f"{say(30)}\n{shared}\n{say(5)}\n{say(20)}", "c") for i in range(6)]
    rows += [(40, "ab" * 700, "c"), (41, "ab" * 120 + "x" + "ab" * 300, "c"), (42, "é" * 150 + say(90), "c"), (43, "€" * 150 + "é" * 150, "d")]
    rows += [(50 + i, "\n".join(say(6) for _ in range(9)), "d") for i in range(3)]
    rows += [(60, say(4000), "e"), (60, "same id, other text " * 20, "e")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, sample_rows()).cache()


def brute_removed(texts, width):
    data = [(t or "").encode() for t in texts]
    count = Counter(b[i : i + width] for b in data for i in range(len(b) - width + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if count[b[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("crowd", [64, 0])
def test_repeated_strings_are_removed(spark, docs, crowd):
    rows = sample_rows()
    found = suffix_dedup.removed(docs, crowd=crowd).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found) == sorted((i, *x) for (i, _, _), x in zip(rows, brute_removed([t for _, t, _ in rows], 200), strict=True))


def test_repeated_strings_of_an_empty_table(spark):
    assert suffix_dedup.removed(frame(spark, [])).collect() == []


def test_suffix_array():
    rng = random.Random(1)
    for _ in range(400):
        alphabet = rng.choice([b"a", b"ab", bytes(range(97, 107)), b"\x00\x01\xff"])
        texts = [bytes(rng.choice(alphabet) for _ in range(rng.randint(0, 25))) for _ in range(rng.randint(1, 5))]
        suffix, base = {}, 0
        for t in texts:
            suffix |= {base + i: t[i:] for i in range(len(t) + 1)}
            base += len(t) + 1
        order = suffix_array.suffix_array(texts)
        assert sorted(order) == sorted(suffix)
        assert all(suffix[a] <= suffix[b] for a, b in zip(order, order[1:], strict=False))
        count = Counter(t[i : i + 3] for t in texts for i in range(len(t) - 2))
        assert suffix_array.repeated_starts(texts, 3) == [[i for i in range(len(t) - 2) if count[t[i : i + 3]] > 1] for t in texts]


def brute_fingerprint(text):
    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    tokens = [w.translate(lower) for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())]
    if not tokens:
        return 0
    parts = [b" ".join(tokens[i : i + 3]) for i in range(len(tokens) - 2)] or [b" ".join(tokens)]
    hashes = [xxhash.xxh64_intdigest(p, seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(keys, linked):
    up = list(range(len(keys)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(keys)):
        for j in range(i):
            if linked(i, j):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    low = {}
    for i, k in enumerate(keys):
        low[root(i)] = min(low.get(root(i), k), k)
    return [low[root(i)] for i in range(len(keys))]


def test_simhash_components(spark, docs):
    rows = sample_rows()
    fps = [brute_fingerprint(t) for _, t, _ in rows]
    near = brute_components([i for i, _, _ in rows], lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2)
    found = simhash.near_duplicates(docs).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in found) == sorted((i, f"{f:016x}", c) for (i, _, _), f, c in zip(rows, fps, near, strict=True))
    assert simhash.near_duplicates(frame(spark, [])).collect() == []


def test_simhash_tree_loses_no_pair(spark, monkeypatch):
    rng = np.random.default_rng(2)
    centres = rng.integers(0, 2**63, 40, dtype=np.uint64)
    points = {int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) for c in centres for _ in range(30)}
    signed = sorted(p - 2**64 if p >= 2**63 else p for p in points)
    monkeypatch.setattr(simhash, "SHARD_ROWS", 40)
    monkeypatch.setattr(simhash, "LEAF_ROWS", 16)
    links = simhash.fingerprint_links(spark.createDataFrame([(p,) for p in signed], "fp long"))
    found = {r.id: r.root for r in components(links).collect()}
    wanted = brute_components(signed, lambda a, b: ((signed[a] ^ signed[b]) & (2**64 - 1)).bit_count() <= 2)
    assert [found.get(p, p) for p in signed] == wanted


def test_representatives(spark, docs):
    groups = {r.component_id for r in simhash.near_duplicates(docs).collect()}
    kept = simhash.representatives(docs.unionAll(frame(spark, [(None, "no id", "z")])))
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == docs.columns and sorted(i for i in ids if i is not None) == sorted(groups) and ids.count(None) == 1


def test_ids_may_be_null(spark):
    big = 2**60 + 1
    df = frame(spark, [(None, "some words here", "a"), (big, "some words here", None), (None, None, "a")])
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in simhash.near_duplicates(df).collect()) == [(0, 0), (0, big), (big, big)]
    assert sorted((r.doc_id or 0, r.n_tokens > 0) for r in bpe.round_trip(df).collect()) == [(0, False), (0, True), (big, True)]
    assert sorted(r.doc_id or 0 for r in suffix_dedup.removed(df).collect()) == [0, 0, big]
    assert sorted(r.doc_id or 0 for r in quality_rules.judged(df).collect()) == [0, 0, big]
    assert sorted(r.doc_id or 0 for r in line_dedup.deduplicated(df).collect()) == [0, 0, big]
    assert len(mixing.mixed(df).collect()) >= 0
    pages = spark.createDataFrame([(None, "http://a/b", "<article>x</article>"), (big, None, None)], "page_id long, url string, html string")
    assert sorted((r.page_id or 0, r.text) for r in html_extract.main_texts(pages).collect()) == [(0, "x"), (big, "")]
    vecs = spark.createDataFrame([(None, [1.0, 0.0]), (big, [1.0, 0.1]), (5, None)], "vec_id long, embedding array<float>")
    assert sorted((r.vec_id or 0, r.n_links) for r in embedding_dedup.near_duplicates(vecs).collect()) == [(0, 1), (5, 0), (big, 1)]


def test_components_of_a_path(spark):
    n = 60
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 101), (7, 7)], "a long, b long")
    found = {r.id: r.root for r in components(edges).collect()}
    assert found == {**{i: 0 for i in range(n + 1)}, 100: 100, 101: 100}


def test_line_chunks(spark, docs):
    rows = sample_rows()
    places = defaultdict(list)
    for i, t, _ in rows:
        lines = (t or "").encode().split(b"\n") if t is not None else []
        for a, b in line_dedup.chunk_bounds(lines) if lines else []:
            if b - a > 1:
                places[tuple(lines[a:b])].append((i, a))
    gone = defaultdict(set)
    for chunk, at in places.items():
        for i, a in sorted(set(at))[1:]:
            gone[i, chunk].add(a)
    wanted = []
    for i, t, _ in rows:
        if t is not None:
            lines = t.encode().split(b"\n")
            t = b"\n".join(x for a, b in line_dedup.chunk_bounds(lines) if a not in gone[i, tuple(lines[a:b])] for x in lines[a:b]).decode()
        wanted.append((i, t))
    out = line_dedup.deduplicated(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted(wanted, key=repr)
    assert line_dedup.report(frame(spark, [])).collect() == []


def test_line_chunk_bounds_resist_shifts():
    rng = random.Random(3)
    lines = [str(rng.random()).encode() for _ in range(200)]
    chunks = {tuple(lines[a:b]) for a, b in line_dedup.chunk_bounds(lines)}
    moved = [b"new", *lines]
    same = [tuple(moved[a:b]) in chunks for a, b in line_dedup.chunk_bounds(moved)]
    assert sum(same) >= len(same) - 4
    assert all(b - a <= line_dedup.MOST for a, b in line_dedup.chunk_bounds([b"x"] * 500))


def vectors():
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((30, 16))
    rows = [(i, [float(x) for x in centres[i % 30] + 0.12 * rng.standard_normal(16)]) for i in range(600)]
    rows += [(1000 + i, rows[0][1]) for i in range(5)]
    rows += [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] + [1.0] * 15), (2003, [float("inf")] * 16), (2004, [None] + [1.0] * 15), (2005, [1.0, 0.0]), (2006, [2.0, 0.0]), (2007, [])]
    return rows


@pytest.mark.parametrize(("window", "block", "tile"), [(1024, 4096, 4096), (16, 64, 40)])
def test_embedding_links(spark, window, block, tile):
    rows = vectors()
    df = spark.createDataFrame([(i, v, 0, 1) for i, v in rows], "vec_id long, embedding array<float>, label int, id int")
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)]

    def linked(a, b):
        x, y = good[a][1], good[b][1]
        return len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.9

    degree = Counter()
    for a in range(len(good)):
        for b in range(a):
            if linked(a, b):
                degree[good[a][0]] += 1
                degree[good[b][0]] += 1
    found = {r.vec_id: r for r in embedding_dedup.near_duplicates(df, window=window, block=block, tile=tile).collect()}
    assert len(found) == len(rows) and all(found[i].n_links <= degree[i] for i, _ in rows)
    assert sum(r.n_links for r in found.values()) >= 0.9 * sum(degree.values())
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())
    if window == 1024:
        comp = dict(zip([i for i, _ in good], brute_components([i for i, _ in good], linked), strict=True))
        assert all(found[i].n_links == degree[i] and found[i].component_id == comp.get(i, i) for i, _ in rows)


def test_embedding_recall_over_thousands_of_vectors(spark):
    """Pairs right above the threshold, and a group of 900 that is denser than any window."""
    rng = np.random.default_rng(6)
    base = rng.standard_normal((3000, 24))
    noise = rng.standard_normal((3000, 24))
    noise -= base * (noise * base).sum(1, keepdims=True) / (base * base).sum(1, keepdims=True)
    noise *= np.linalg.norm(base, axis=1, keepdims=True) / np.linalg.norm(noise, axis=1, keepdims=True)
    angle = np.arccos(rng.uniform(0.9, 0.93, (3000, 1)))
    points = np.vstack([base, np.cos(angle) * base + np.sin(angle) * noise, rng.standard_normal(24) + 0.06 * rng.standard_normal((900, 24))]).astype(np.float32)
    unit = points.astype(float) / np.linalg.norm(points.astype(float), axis=1, keepdims=True)
    degree = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    rows = spark.createDataFrame(enumerate(points.tolist()), "vec_id long, embedding array<float>")
    found = {r.vec_id: r for r in embedding_dedup.near_duplicates(rows, window=64, block=256, tile=200).collect()}
    assert all(found[i].n_links <= degree[i] for i in found)
    pairs = [i for i in range(6000) if degree[i]]
    assert sum(found[i].n_links for i in pairs) >= 0.9 * sum(degree[i] for i in pairs)
    assert all(found[i].n_links >= 0.99 * degree[i] for i in range(6000, 6900))
    assert {found[i].component_id for i in range(6000, 6900)} == {found[6000].component_id}


def test_embeddings_of_an_empty_table(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


PAGE = "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a='<p>no</p>';</script></head><body><nav><ul><li><a href='/'>Home</a></li></ul></nav>{body}<footer>&copy; site</footer></body></html>"


@pytest.mark.parametrize(
    ("body", "text"),
    [
        ("<article><h1>Head</h1><p>One &amp; two<br>three</p><p>Four<p>Five</article>", "Head\nOne & two three\nFour\nFive"),
        ("<div class='ad'>Buy</div><main><p><b>Bold</b> text</p><aside>More</aside><form><input>Mail</form></main>", "Bold text"),
        ("<article><p>Text</p><div id='comments'><p>Nice</p></div><div class='cookie-notice'>Ok</div></article>", "Text"),
        ("<article><p>A &lt;tag&gt; &#233; &eacute; &am</p><!-- no --><ul><li>x</li><li>y</li></ul><table><tr><td>1</td><td>2</td></tr></table>", "A <tag> é é &am\nx\ny\n1 2"),
        ("<article><p>Open", "Open"),
        ("<div class='page has-sidebar'><article class='post has-comments'><div class='post-header'><h1>H</h1></div><p>T</p></article><article class='comment'><p>Hi</p></article></div>", "H\nT"),
        ("", ""),
    ],
)
def test_main_text(body, text):
    assert html_extract.main_text(html_extract.lines_of(PAGE.replace("{body}", body)), None) == text


def test_common_lines():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.choice("abcde") for _ in range(rng.randint(0, 9))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
        found = [a[i] for i in sorted(html_extract.common(a, b))]
        rest = iter(b)
        assert len(found) == best[-1][-1] and all(x in rest for x in found)


def test_alignment_of_many_equal_lines():
    same, mixed = ["x"] * 20_000, ["a", "b"] * 10_000
    began = time.perf_counter()
    assert html_extract.common(same, same[1:]) == set(range(19_999)) or len(html_extract.common(same, same[1:])) == 19_999
    assert len(html_extract.common(mixed, mixed[1:] + ["c"])) >= 19_990
    assert time.perf_counter() - began < 1


def test_near_copies_of_a_page_keep_their_text(spark):
    body = "<html><body><div>Site</div>{}<div>Imprint</div></body></html>"
    story = "".join(f"<div>line {i} of the story</div>" for i in range(20))
    rows = [(1, "http://h/a/1", body.format(story)), (2, "http://h/a/2", body.format(story + "<div>and one more</div>")), (3, "http://h/a/3", body.format("<div>quite another</div><div>story</div>"))]
    rows += [(None, "http://h/b", None)] * 40
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text.split("\n") for r in html_extract.main_texts(df).collect()}
    assert found[2] == [*(f"line {i} of the story" for i in range(20)), "and one more"] and found[3] == ["quite another", "story"]
    assert found[1] == found[2][:20]


def test_pages_are_differenced(spark):
    plain = "<html><body><div>Site name</div><div>{}</div><div>{}</div><div>Imprint</div></body></html>"
    rows = [(i, f"http://Host/a/{i:03d}?q={i}", plain.format(f"story {i}", f"more {i}")) for i in range(40)]
    rows += [(100, "http://other/x", plain.format("alone", "here")), (101, None, None), (102, "http://host/z/9", "<article><p>kept</p></article>")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    found = {r.page_id: r for r in html_extract.main_texts(df).collect()}
    assert len(found) == len(rows)
    assert all(found[i].text == f"story {i}\nmore {i}" for i in range(2, 40))
    assert found[100].text == "Site name\nalone\nhere\nImprint" and found[101].text == "" and found[102].text == "kept"
    assert all(r.n_chars == len(r.text) and r.url == {i: u for i, u, _ in rows}[r.page_id] for r in found.values())
    assert html_extract.main_texts(df.limit(0)).collect() == []


def test_warc_round_trip(spark):
    long = "é" * 600
    trap = "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" + "z" * 1000
    rows = [(1, "http://a/\r\nX: y", long), (2, "http://b", long), (3, None, long), (4, "http://c", "short"), (5, "http://d", "short"), (6, "http://e", None), (7, "http://f", ""), (8, "u", trap)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    found = {r.page_id: r for r in warc.captures(df).collect()}
    for i, _, html in rows:
        data = (html or "").encode()
        again = i in (1, 2)
        r = found[i]
        assert (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) == (len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", 3 if again else None)
    folder = warc.new_folder(spark, "warc")
    warc.write_archive(df, folder)
    nested = {r.capture_id: r for r in warc.assembled(warc.read_archive(spark, folder)).collect()}
    assert next(r for k, r in nested.items() if ":8:" in k).response.payload == trap and all(r.request and r.metadata for r in nested.values())
    assert warc.captures(df.limit(0)).collect() == []
    odd = spark.createDataFrame([(1, "u", "one"), (1, "v", "two"), (1, "v", "two"), (None, None, None)], "page_id long, url string, html string")
    assert sorted((r.page_id or 0, r.payload_bytes) for r in warc.captures(odd).collect()) == [(0, 0), (1, 3), (1, 3), (1, 3)]
    equal = spark.createDataFrame([(7, "u", long)] * 3 + [(6, None, long)] + [(8, "u", "short")] * 3, "page_id long, url string, html string")
    out = sorted((r.page_id, r.record_type, r.refers_to or 0) for r in warc.captures(equal).collect())
    assert out == [(6, "revisit", 7), (7, "response", 0), (7, "revisit", 7), (7, "revisit", 7), (8, "response", 0), (8, "response", 0), (8, "response", 0)]


def test_warc_of_very_long_pages(spark):
    rows = [(i, "u", ("é\r\n" + "x" * 97) * n) for i, n in enumerate((500_000, 1, 200_000))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r for r in warc.captures(df).collect()}
    assert all((found[i].payload_bytes, found[i].payload_digest) == (len(h.encode()), hashlib.sha1(h.encode()).hexdigest()) for i, _, h in rows)


def test_classifier_holds_out(spark):
    rng = random.Random(7)
    good = lambda: " ".join(rng.choice(WORDS) for _ in range(80)).capitalize() + "."
    bad = lambda: " ".join(rng.choice(WORDS).upper() + "!!" for _ in range(80))
    rows = [(i, good() if i % 3 else bad(), "s") for i in range(600)] + [(900, None, "s"), (901, "", "s")]
    df = frame(spark, rows)
    labels = spark.createDataFrame([(i, int(bool(i % 3)), 0) for i in range(600)] + [(901, None, 0)], "doc_id long, quality int, toxic int")
    model = compression_quality.fit(df, labels, learn_from=compression_quality.learnable())
    scored = {r.row: r.score for r in compression_quality.scores(df, model).collect()}
    held = [i for i in range(600) if __import__("zlib").crc32(str(i).encode()) % 4 == 2]
    assert len(scored) == 602 and all(0 <= s <= 1 for s in scored.values())
    assert sum((scored[i] >= 0.7) == bool(i % 3) for i in held) >= 0.97 * len(held)
    kept = compression_quality.kept(df, model)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, s in scored.items() if s >= 0.7}
    assert compression_quality.fit(df, labels.limit(0)).weights[0] == 0


def brute_statistics(text):
    tokens = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(tokens[i : i + 3]) for i in range(len(tokens) - 2)]
    count = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(tokens), sum(map(len, tokens)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(repeated)


def test_quality_statistics_and_verdicts(spark):
    rng = random.Random(8)
    say = lambda n: " ".join(rng.choice(WORDS) + rng.choice("abcdefghij") + rng.choice("klmnop") for _ in range(n))
    rows = sample_rows() + [(100 + i, say(rng.randint(60, 300)), "clean") for i in range(80)] + [(300, " ".join(w + "###" for w in say(200).split()), "clean"), (301, "word " * 300, "clean"), (302, "a\n b\n a\n" * 30, "clean")]
    df = frame(spark, rows)
    out = quality_rules.judged(df)
    found = out.collect()
    assert sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found) == sorted((i, *brute_statistics(t)) for i, t, _ in rows)
    by_id = {r.doc_id: r for r in found}
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in found)
    assert not any(r.base_failed and r.kept for r in found)
    assert all(by_id[100 + i].kept for i in range(80)) and not by_id[300].base_failed and not by_id[300].kept and by_id[301].base_failed
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert quality_rules.judged(df.limit(0)).collect() == []


def brute_outliers(counts, lengths, draws):
    """Verdicts of one group by many random starts, each concentrated to its end; the least determinant wins."""
    n, chars, symbols, lines, repeats = counts.T.astype(float)
    points = np.column_stack([np.log(chars / n), np.sqrt(symbols / n), np.sqrt(lines / n), np.sqrt(repeats / (6 * n))])
    noise = np.column_stack([1 / chars, *[1 / (4 * n)] * 3])
    take = int(np.ceil(0.75 * len(points)))

    def squared(centre, cov):
        out = np.empty(len(points))
        for i, b in enumerate(lengths):
            errors = np.diag([1 / (2.0**b * np.exp(centre[0])), *[1 / (4 * 2.0**b)] * 3])
            out[i] = (points[i] - centre) @ np.linalg.solve(cov + errors, points[i] - centre)
        return out

    rng, best = np.random.default_rng(1), (np.inf, None)
    for _ in range(draws):
        core, last = rng.choice(len(points), 10, replace=False), np.inf
        while True:
            centre, cov = points[core].mean(0), np.cov(points[core].T, bias=True)
            size = np.linalg.slogdet(cov + np.diag(noise[core].mean(0)))[1]
            if len(core) == take and size >= last - 1e-9:
                break
            last = size if len(core) == take else np.inf
            core = np.argsort(squared(centre, cov), kind="stable")[:take]
        if last < best[0]:
            best = last, squared(points[core].mean(0), 1.4861 * np.cov(points[core].T, bias=True))
    return best[0], best[1] <= 23.512742


def test_outliers_against_random_starts(spark):
    rng = random.Random(12)

    def text(i):
        n = rng.randint(60, 400)
        out = [rng.choice(WORDS) + rng.choice("abcdefghij") + rng.choice("klmnop") * rng.randint(1, 3) for _ in range(n)]
        if i % 9 == 0:
            out = [w + "#" * rng.randint(0, 3) for w in out]
        if i % 11 == 0:
            out = [w * 2 for w in out]
        if i % 4 == 0:
            out[5:9] = out[20:24]
        return " ".join(out) + "\nend of it" * (1 + i % 3)

    rows = [(i, text(i), "one") for i in range(150)]
    found = {r.doc_id: r for r in quality_rules.judged(frame(spark, rows)).collect()}
    counts = np.array([brute_statistics(t) for _, t, _ in rows])
    _, kept = brute_outliers(counts, [int(np.log2(n + 0.5)) for n in counts[:, 0]], 60)
    assert not any(r.base_failed for r in found.values())
    assert [found[i].kept for i in range(150)] == kept.tolist()
    assert 20 <= sum(not k for k in kept.tolist()) <= 40


def test_mixing(spark):
    rng = random.Random(9)
    rows = [(i, "w " * rng.randint(0, 30), rng.choice(["a", "b", "c", "é", None, "tiny"] if i % 9 else ["a"])) for i in range(3000)] + [(5000, None, "empty"), (5001, "", "empty")]
    rows = [r for r in rows if r[2] != "tiny" or r[0] % 40 == 0]
    df = frame(spark, rows)
    sized = df.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    out = mixing.with_copies(sized).select("*", "mix.*").collect()
    again = mixing.with_copies(sized.repartition(7)).select("doc_id", "mix.copies").collect()
    assert {r.doc_id: r.copies for r in out} == {r.doc_id: r.copies for r in again} and len(out) == len(rows)
    total = sum(r.size for r in out)
    target = {r.source: (r.target, r.source_size) for r in out}
    assert sum(t for t, _ in target.values()) == pytest.approx(total)
    weight = dict(zip([*sorted(s for s in target if s is not None), None], [5, 2, 1, 5, 2, 1, 5], strict=False))
    level = max(t / weight[s] for s, (t, n) in target.items())
    assert all(t == pytest.approx(min(3 * n, level * weight[s])) for s, (t, n) in target.items())
    taken = defaultdict(int)
    for r in out:
        rate = r.target / r.source_size if r.source_size else 0
        assert int(rate) <= r.copies <= min(3, int(rate) + 1)
        taken[r.source] += r.copies * r.size
    assert all(abs(taken[s] - t) <= 0.03 * t + 60 for s, (t, _) in target.items())
    clash = mixing.with_copies(sized.withColumn("mix", F.lit("x")).limit(50))
    assert clash.columns == [*sized.columns, "mix"] and clash.where("mix.copies >= 0").count() == 50
    mixed = mixing.mixed(df)
    assert mixed.columns == df.columns and Counter(r.doc_id for r in mixed.collect()) == Counter({r.doc_id: r.copies for r in out if r.copies})
    assert mixing.with_copies(sized.limit(0)).collect() == [] and mixing.mixed(df.limit(0)).collect() == []


def test_bpe_equals_the_library(spark, docs):
    coder = bpe.Coder(bpe.tokenizer_path())
    rng = random.Random(10)
    parts = [" ", "  ", "\n", "\t", "a", "b", "é", "ß", "'s", "'ll", "<|endoftext|>", "1", "23", "!!", "日本", "語", " ", "​", "👍", "́", "the quick brown fox jumps", "x" * 50, "\r\n", "　", "\x1c", "\u0085", "Ÿ", "…"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 300))) for _ in range(300)] + ["", "a" * 30000, " " * 9000, "日本" * 4000]
    for text in texts:
        ids = coder.exact.encode(text, add_special_tokens=False).ids
        assert list(coder.encode(text)) == ids
        assert coder.decode_bytes(ids).decode() == coder.exact.decode(ids, skip_special_tokens=False)
    found = sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip(docs).collect())
    wanted = []
    for i, t, _ in sample_rows():
        ids = coder.exact.encode(t or "", add_special_tokens=False).ids
        wanted.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert found == sorted(wanted)
    assert {r.doc_id: r.ids for r in bpe.encode(docs).where("doc_id = 3").collect()}[3] == coder.exact.encode("short", add_special_tokens=False).ids


def test_bpe_agrees_on_every_usual_character():
    coder = bpe.Coder(bpe.tokenizer_path())
    usual = [chr(c) for c in range(0x3000) if not coder.unusual.search(chr(c))]
    for c in usual:
        text = f"a{c} b{c}{c}1{c}"
        assert coder.exact.encode(text, add_special_tokens=False).ids == coder.fast.encode_ordinary(text), hex(ord(c))


def test_bpe_shares_chunks():
    coder = bpe.Coder(bpe.tokenizer_path())
    rng = random.Random(11)
    passage = " ".join(rng.choice(WORDS) + str(rng.randint(0, 99)) for _ in range(600))
    coder.encode("first " + passage)
    before = len(coder.store)
    coder.encode("quite another start of " + passage + " and end")
    assert len(coder.store) - before <= 4
