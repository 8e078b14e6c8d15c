"""Robust multivariate outliers: minimum-covariance-determinant estimates per language and source, in DataFrame operations only.

Statistics are rates of counts, transformed so that the error of counting is known: a document of n words can't tell its
own rate of symbols better than a Poisson count does. A document is therefore held against the covariance of its group
plus the variance of counts over texts of its length. Nothing is scaled by hand or fitted to labels, and a statistic that never varies
in a group's core (most texts have no symbol at all) still has a defined distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.llm.shared import SPACE, drop_written, text_of, words, written

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
#: Share of a group that estimates rest on, and concentration steps at most; a start whose determinant falls no more ends before.
CORE, STEPS, FALL = 0.75, 8, 0.01
MIN_GROUP = 40
FEATURES = ("f0", "f1", "f2", "f3")
#: Consistency at the normal model of 4 dimensions: 0.75 over the share that 6 degrees of freedom have below the 0.75 quantile of 4.
CONSISTENCY = 1.4861
#: Chi-square with 4 degrees of freedom at 0.9999.
CHI_CUT = 23.512742
ACCURACY = 10000
#: Rows of a group are dealt to as many parts, and to bands of length, wherever Spark joins them with the group's estimates by a shuffle.
SALTS = 8
#: Bands of length, as powers of two of the number of words; texts of the base rule's length and more have a band, the longest share the last.
FIRST_BAND, LAST_BAND = 5, 24
PAIRS = [(i, j) for i in range(len(FEATURES)) for j in range(i + 1)]


def let(value: Column, body) -> Column:
    """body(value) with value computed once: as a lambda's variable it is not repeated in the plan."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeat_words(tokens: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the text.

    Windows become hashes; where these are all different nothing repeats. Else they become (hash, position), sorted by
    hash; a window equal to its neighbour in that order repeats. Sorting the positions again turns the union of windows
    into a sum of steps of at most 3. Linear space, n log n time.
    """
    def hashes(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def marked(h: Column) -> Column:
        return let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), lambda s: F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"])))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def repeated(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(F.sort_array(F.transform(marked(h), lambda x: x["i"])), covered))

    return let(tokens, lambda w: F.when(F.size(w) < 4, F.lit(0)).otherwise(let(hashes(w), repeated)))


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add `stats` struct<n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words>, all long, of whole texts; null is empty."""
    body = text_of(text)
    lines = F.filter(F.split(body, "\n", -1), lambda line: F.btrim(line, F.lit(SPACE)) != "")
    tokens = words(body)
    return docs.withColumn(
        "stats",
        F.struct(
            F.size(tokens).cast("long").alias("n_words"),
            F.length(F.translate(body, SPACE, "")).cast("long").alias("word_chars"),
            (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            repeat_words(tokens).cast("long").alias("n_repeat_words"),
        ),
    )


def transformed(n_words: Column, word_chars: Column, n_symbols: Column, n_dup_lines: Column, n_repeat_words: Column) -> list[Column]:
    """Log of the mean word length, and square roots, which have the same error whatever the rate, of symbols, repeated
    lines and repeats per word; a repeat is two windows of three words."""
    return [F.log(word_chars / n_words), F.sqrt(n_symbols / n_words), F.sqrt(n_dup_lines / n_words), F.sqrt(n_repeat_words / (6 * n_words))]


def counting_errors(n_words: Column, word_chars: Column) -> tuple[Column, Column]:
    """Variances by counting alone: of the log of a Poisson count, and of the square root of a rate."""
    return 1 / word_chars, 1 / (4 * n_words)


def factored(rows: DataFrame) -> DataFrame:
    """Add the lower Cholesky factor l{i}{j} of the covariance c{i}{j} plus counting errors v0, v1 on its diagonal."""
    out = rows
    for i, j in PAIRS:
        rest = F.col(f"c{i}{j}") + (F.col("v0" if i == 0 else "v1") if i == j else F.lit(0.0))
        for k in range(j):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}"))
    return out


def banded(groups: DataFrame) -> DataFrame:
    """Centres and covariances as (m, l, band): the Cholesky factor for texts of each band of length, whose counting
    errors are those of its shortest text with the group's words."""
    bands = groups.withColumn("band", F.explode(F.sequence(F.lit(FIRST_BAND), F.lit(LAST_BAND))))
    least = F.pow(F.lit(2.0), F.col("band"))
    errors = counting_errors(least, least * F.exp("m0"))
    out = factored(bands.withColumn("v0", errors[0]).withColumn("v1", errors[1]))
    return out.drop("v0", "v1", *[f"c{i}{j}" for i, j in PAIRS])


def distance() -> Column:
    """Squared Mahalanobis distance of f from m, by forward substitution in the Cholesky factor l."""
    solved: list[Column] = []
    for i, f in enumerate(FEATURES):
        rest = F.col(f) - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * solved[j]
        solved.append(rest / F.col(f"l{i}{i}"))
    return sum((x * x for x in solved[1:]), solved[0] * solved[0])


def of_group(rows: DataFrame, groups: DataFrame, how: str = "inner") -> DataFrame:
    """Rows (key, salt, band, ...) with what a written table of groups, perhaps by band, says of their key. Where the
    table is small Spark broadcasts it as measured; else rows of a key meet its SALTS copies in as many places."""
    copies = groups.withColumnRenamed("key", "group_key").withColumn("group_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    on = (F.col("key") == F.col("group_key")) & (F.col("salt") == F.col("group_salt"))
    if "band" in groups.columns:
        copies = copies.withColumnRenamed("band", "group_band")
        on = on & (F.col("band") == F.col("group_band"))
    return rows.join(copies, on, how).drop("group_key", "group_salt", "group_band")


def quantile(x: Column | str, q: float) -> Column:
    return F.percentile_approx(x, q, ACCURACY)


def moments() -> list[Column]:
    """Centre, covariance and mean counting errors of a group's rows."""
    out = [F.avg(f).alias(f"m{i}") for i, f in enumerate(FEATURES)]
    out += [F.coalesce(F.covar_pop(FEATURES[i], FEATURES[j]), F.lit(0.0)).alias(f"c{i}{j}") for i, j in PAIRS]
    return out + [F.avg("v0").alias("e0"), F.avg("v1").alias("e1")]


def log_determinant(groups: DataFrame) -> DataFrame:
    """Add `size`, the log of the determinant of covariance plus mean counting errors."""
    out = factored(groups.withColumnsRenamed({"e0": "v0", "e1": "v1"})).withColumnsRenamed({"v0": "e0", "v1": "e1"})
    size = sum((2 * F.log(f"l{i}{i}") for i in range(1, len(FEATURES))), 2 * F.log("l00"))
    return out.withColumn("size", size).drop(*[f"l{i}{j}" for i, j in PAIRS])


def starts(rows: DataFrame) -> DataFrame:
    """Three deterministic first estimates of each key (start 0, 1, 2): medians with median deviations; medians with the
    covariance of directions (spatial signs); mean and covariance of the half nearest the medians."""
    n = len(FEATURES)
    middle = written(rows.groupBy("key").agg(*[quantile(f, 0.5).alias(f"m{i}") for i, f in enumerate(FEATURES)], F.avg("v0").alias("e0"), F.avg("v1").alias("e1")), "middle")
    away = [F.abs(F.col(f) - F.col(f"m{i}")) for i, f in enumerate(FEATURES)]
    spread = of_group(rows, middle.drop("e0", "e1")).groupBy("key").agg(*[quantile(x, 0.5).alias(f"s{i}") for i, x in enumerate(away)])
    scaled = [F.sqrt(F.pow(1.4826 * F.col(f"s{i}"), 2) + F.col("e0" if i == 0 else "e1")).alias(f"s{i}") for i in range(n)]
    base = written(middle.join(spread, "key").select("key", *[f"m{i}" for i in range(n)], *scaled, "e0", "e1"), "base")
    drop_written(middle)
    z = of_group(rows, base).select("key", *FEATURES, "v0", "v1", *[((F.col(f) - F.col(f"m{i}")) / F.col(f"s{i}")).alias(f"z{i}") for i, f in enumerate(FEATURES)])
    z = z.withColumn("far", sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(1, n)), F.col("z0") * F.col("z0")))
    sign = [F.avg(F.when(F.col("far") > 0, F.col(f"z{i}") * F.col(f"z{j}") / F.col("far")).otherwise(0.0)).alias(f"u{i}{j}") for i, j in PAIRS]
    signs = written(z.groupBy("key").agg(quantile("far", 0.5).alias("half"), *sign), "signs")
    halves = written(base.join(signs.select("key", "half"), "key"), "halves")
    near = of_group(rows, halves)
    far = sum((F.pow((F.col(FEATURES[i]) - F.col(f"m{i}")) / F.col(f"s{i}"), 2) for i in range(1, n)), F.pow((F.col("f0") - F.col("m0")) / F.col("s0"), 2))
    third = near.where(far <= F.col("half")).groupBy("key").agg(*moments())
    names = ["key", "start", *[f"m{i}" for i in range(n)], *[f"c{i}{j}" for i, j in PAIRS], "e0", "e1"]
    first = base.select("*", F.lit(0).alias("start"), *[(F.pow(F.col(f"s{i}"), 2) if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in PAIRS])
    second = base.join(signs, "key").select("*", F.lit(1).alias("start"), *[(n * F.col(f"u{i}{j}") * F.col(f"s{i}") * F.col(f"s{j}")).alias(f"c{i}{j}") for i, j in PAIRS])
    both = first.select(*names).unionAll(second.select(*names)).unionAll(third.withColumn("start", F.lit(2)).select(*names))
    return both.withColumn("size", F.lit(float("inf"))).withColumn("falls", F.lit(True))


def estimates(rows: DataFrame) -> DataFrame:
    """(key, salt, f0..f3, v0, v1) -> one row per key: centre m, covariance c and log determinant of its densest core.

    Concentration: take the CORE share of a group that lies nearest, that share's mean and covariance, and again, from
    each start until the determinant falls no more; the start with the least determinant wins. Every aggregate is
    combined before its shuffle (quantile sketches, means, covariances), so one group may hold most rows; estimates are
    a table each step, which replaces the one before.
    """
    groups = written(starts(rows), "groups")
    keep = ["key", "start", *[f"m{i}" for i in range(len(FEATURES))], *[f"c{i}{j}" for i, j in PAIRS]]
    for _ in range(STEPS):
        live = written(banded(groups.where("falls").select(*keep)), "live")
        cuts = written(of_group(rows, live).groupBy("key", "start").agg(quantile(distance(), CORE).alias("q")), "cuts")
        near = written(live.join(cuts, ["key", "start"]), "core")
        core = of_group(rows, near).where(distance() <= F.col("q")).groupBy("key", "start").agg(*moments())
        new = log_determinant(core)
        old = groups.select("key", "start", F.struct(*[c for c in groups.columns if c not in ("key", "start")]).alias("old"))
        joined = old.join(new.select("key", "start", F.struct(*[c for c in new.columns if c not in ("key", "start")], F.lit(True).alias("falls")).alias("new")), ["key", "start"], "left")
        falls = F.coalesce(F.col("new.size") < F.col("old.size") - FALL, F.lit(False))
        fields = [c for c in groups.columns if c not in ("key", "start", "falls")]
        after = written(joined.select("key", "start", *[F.when(falls, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in fields], falls.alias("falls")), "groups")
        for done in (groups, live, cuts, near):
            drop_written(done)
        groups = after
        if groups.where("falls").isEmpty():
            break
    best = groups.groupBy("key").agg(F.min_by(F.struct(*[c for c in groups.columns if c != "key"]), F.struct("size", "start")).alias("best"))
    return best.select("key", "best.*").drop("start", "falls", "e0", "e1")


def judged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per document: doc_id, statistics, base_failed, kept, and `distance` (squared), null if it wasn't measured.

    Base rule: fewer than 50 words, or over half of the words in repeated windows. The others of a language and source
    are held against that group's estimates; groups of under MIN_GROUP documents pool by language (null is a value of
    its own), and pools still smaller judge nothing: their documents are kept. Null and empty texts have no words and
    fail the base rule; repeated rows each count; an empty table gives an empty one.
    """
    s = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("text"))
    s = statistics(s).select("doc_id", "lang", "source", "stats.*")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    s = s.withColumn("base_failed", failed)
    rates = transformed(*[F.col(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")])
    errors = counting_errors(F.col("n_words"), F.col("word_chars"))
    measured = [*zip(FEATURES, rates, strict=True), *zip(("v0", "v1"), errors, strict=True)]
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    band = F.least(F.lit(LAST_BAND), F.floor(F.log2(F.col("n_words") + F.lit(0.5))).cast("int"))
    s = written(s.select("*", salt.alias("salt"), band.alias("band"), *[F.when(~F.col("base_failed"), x).alias(f) for f, x in measured]), "stats")
    tag = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-"))
    s = s.withColumn("small_key", F.concat_ws("\x1f", tag("lang"), tag("source"))).withColumn("large_key", tag("lang"))
    good = s.where(~F.col("base_failed"))
    sizes = written(good.groupBy("small_key", "large_key").agg(F.count(F.lit(1)).alias("n")), "sizes")
    pooled = sizes.groupBy("large_key").agg(F.sum(F.when(F.col("n") < MIN_GROUP, F.col("n"))).alias("pool"))
    key = F.when(F.col("n") >= MIN_GROUP, F.col("small_key")).when(F.col("pool") >= MIN_GROUP, F.col("large_key"))
    keys = written(sizes.join(pooled, "large_key").select(F.col("small_key").alias("key"), key.alias("pool_key")), "keys")
    drop_written(sizes)
    keyed = of_group(good.withColumn("key", F.col("small_key")), keys).where("pool_key is not null").withColumn("key", F.col("pool_key"))
    rows = keyed.select("key", "salt", "band", *FEATURES, "v0", "v1")
    pools = banded(estimates(rows).drop("size").withColumnsRenamed({"key": "pool_key"}).withColumns({f"c{i}{j}": CONSISTENCY * F.col(f"c{i}{j}") for i, j in PAIRS}))
    limits = written(keys.join(pools, "pool_key").drop("pool_key"), "limits")
    drop_written(keys)
    found = of_group(s.withColumn("key", F.when(~F.col("base_failed"), F.col("small_key"))), limits, "left").withColumn("distance", distance())
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= CHI_CUT, F.lit(True))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "distance")
