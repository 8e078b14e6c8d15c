"""Pages without an article: sites whose frame is most of every page, near copies, and a brute-force version of the result."""

import random

import pytest

from geoloom.llm import html_extract as h

KIND = "page_id long, url string, html string"


def page(lines):
    return "<html><body>" + "".join(f"<div>{x}</div>" for x in lines) + "</body></html>"


@pytest.mark.parametrize("own", [5, 15, 25])
def test_frames_that_are_most_of_a_page(spark, own):
    frame = [f"site line {i}" for i in range(80)]
    rows = [(k, f"http://a/x/{k}", page(frame[:40] + [f"own {k} {i}" for i in range(own)] + frame[40:])) for k in range(3)]
    found = {r.page_id: r.text for r in h.main_texts(spark.createDataFrame(rows, KIND)).collect()}
    assert found == {k: "\n".join(f"own {k} {i}" for i in range(own)) for k in range(3)}


def site(rng, host, frame, articles, copies):
    """Pages of one host: articles in one frame, some of them several times with a line or two changed."""
    out = []
    for a in range(articles):
        body = [f"{host} article {a} line {i} {rng.random():.9f}" for i in range(rng.randint(12, 20))]
        for c in range(copies if a % 4 == 0 else 1):
            own = list(body)
            if c:
                own[rng.randrange(len(own))] = f"{host} {a} {c} changed"
            out.append((f"http://{host}/s{a % 3}/{a:03}?copy={c}", frame[: len(frame) // 2] + own + frame[len(frame) // 2 :], own))
    return out


def brute(rows):
    """The same rule, page by page over whole hosts, with a plain table for the common subsequence."""

    def subsequence(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in reversed(range(len(a))):
            for j in reversed(range(len(b))):
                best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
        found, i, j = set(), 0, 0
        while i < len(a) and j < len(b):
            if a[i] == b[j]:
                found.add(i)
                i, j = i + 1, j + 1
            elif best[i + 1][j] >= best[i][j + 1]:
                i += 1
            else:
                j += 1
        return found

    alike = lambda a, b: sum(min(a.count(x), b.count(x)) for x in set(a)) >= 0.8 * max(len(a), len(b))
    order = sorted((*h.place(url), i, lines) for i, url, lines in rows)
    out = {}
    for at, (host, path, i, lines) in enumerate(order):
        near = [order[k] for k in (at - 1, at + 1) if 0 <= k < len(order) and order[k][0] == host]
        if not near:
            out[i] = lines
            continue
        partner = max(near, key=lambda x: (not alike(x[3], lines), h.likeness(x[1], path)))
        shared = subsequence(lines, partner[3])
        if alike(lines, partner[3]):
            pages = {tuple(x[3]) for x in order if x[0] == host}
            site = {x for x in lines if len(pages) >= 3 and 3 * sum(x in p for p in pages) > 2 * len(pages)}
            shared = {k for k in shared if lines[k] in site}
        out[i] = [x for k, x in enumerate(lines) if k not in shared]
    return out


def test_whole_result_equals_brute_force(spark):
    rng = random.Random(4)
    made = []
    for n, (frame, articles, copies) in enumerate([(4, 9, 1), (60, 8, 1), (4, 12, 5), (60, 12, 3), (3, 1, 1), (3, 1, 4), (0, 5, 2)]):
        made += site(rng, f"h{n}", [f"h{n} frame {i}" for i in range(frame)], articles, copies)
    rows = [(i, url, lines) for i, (url, lines, _) in enumerate(made)]
    table = spark.createDataFrame([(i, url, page(lines)) for i, url, lines in rows] + [(9000, None, None), (9001, "http://h0/none", None)], KIND).repartition(3)
    found = {r.page_id: r.text for r in h.main_texts(table).collect()}
    wanted = brute([*rows, (9000, None, []), (9001, "http://h0/none", [])])
    assert found == {i: "\n".join(x) for i, x in wanted.items()}
    # And what the pages were made of: frames go, articles stay, where a host has enough different pages.
    right = sum(found[i] == "\n".join(own) for i, (_, _, own) in enumerate(made) if made[i][0].split("/")[2] in ("h0", "h1", "h2", "h3"))
    assert right >= 0.9 * sum(m[0].split("/")[2] in ("h0", "h1", "h2", "h3") for m in made)
