"""Quality rules: fixed base rules, then robust multivariate outliers per language and source.

The statistics of a text are turned into a vector (mean word length, shares of symbols, capitals, repeated lines and
repeated words, transformed). For each language and source a minimum-covariance-determinant estimate of centre and
scatter is computed by concentration steps: start from medians and quartiles, then again and again take the
``CORE`` share of rows nearest by Mahalanobis distance and their mean and covariance, until the core stays as it is. Every
language and source has an estimate of its own, drawn towards that of its language by as much as ``PRIOR`` rows weigh: one
of few rows has nearly the estimate of the language, one of many its own, and nothing depends on passing a size. Rows far
from the centre are rejected.

All steps are DataFrame aggregations; the nearest rows are found from exact counts of distance steps, so no group is
ever in one place and no row leaves Spark. Scatter has a floor (``FLOOR``), so constant statistics (no symbols at all) do not make every change an outlier.

Null and empty texts have no word and fail the base rules. A null language or source counts as an empty one. Repeated
rows get the same verdict. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import stored

LEAST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8
#: fixed values: white space between words, symbols
BLANK, SYMBOLS = r"[ \x09-\x0D]+", "#*$%&|<>"
CORE = 0.75
#: Concentration steps end when no core changes; counts of distance steps can make a core swing, so there is an end.
STEPS = 20
#: Rows that the estimate of the language weighs.
PRIOR = 200
#: Rows beyond this quantile of the chi-squared distribution are rejected.
QUANTILE = 0.99999
#: Least standard deviation of each entry of the vector.
FLOOR = (0.12, 0.4, 0.03, 0.09, 0.08)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANK), "")


def repeated_words(found: Column, k: int = WINDOW) -> Column:
    """Words in windows of ``k`` words that occur twice or more, the first occurrence included."""

    def hashes(ws: Column) -> Column:
        # each word becomes a number once; a window is hashed from k numbers
        return let(
            F.transform(ws, lambda w: F.xxhash64(w)),
            lambda hs: F.transform(
                F.sequence(F.lit(1), F.size(hs) - (k - 1)), lambda i: F.xxhash64(*[F.try_element_at(hs, i + j) for j in range(k)])
            ),
        )

    def covered(hs: Column) -> Column:
        pairs = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(ps: Column) -> Column:
            def same(p: Column, n: Column) -> Column:
                return (p["h"] == F.get(ps, n - 1)["h"]) | (p["h"] == F.get(ps, n + 1)["h"])

            return F.sort_array(F.transform(F.filter(ps, lambda p, n: F.coalesce(same(p, n), F.lit(False))), lambda p: p["i"]))

        def total(at: Column) -> Column:
            step = F.transform(at, lambda i, n: F.least(F.lit(k), F.coalesce(F.get(at, n + 1) - i, F.lit(k))))
            return F.aggregate(step, F.lit(0).cast("long"), lambda a, s: a + s.cast("long"))

        return let(let(pairs, positions), total)

    def counted(hs: Column) -> Column:
        return F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0).cast("long")).otherwise(covered(hs))

    return F.when(F.size(found) <= k, F.lit(0).cast("long")).otherwise(let(hashes(found), counted))


def measured(documents: DataFrame) -> DataFrame:
    """doc_id, lang, source and the statistics of each whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def all_of(ws: Column) -> Column:
        joined = F.array_join(ws, "")
        return F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.length(joined).cast("long").alias("word_chars"),
            repeated_words(ws).alias("n_repeat_words"),
        )

    def repeats(lines: Column) -> Column:
        return let(lines, lambda ls: F.struct(F.size(ls).alias("n"), (F.size(ls) - F.size(F.array_distinct(ls))).alias("again")))

    lines = F.filter(F.split(text, "\n"), lambda line: F.length(F.btrim(line, F.lit(" \t\x0b\x0c\r"))) > 0)
    rows = documents.select(
        "doc_id",
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        let(words(text), all_of).alias("w"),
        F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long").alias("n_capitals"),
        repeats(lines).alias("l"),
    )
    return rows.select(
        "doc_id", "lang", "source", "w.n_words", "w.word_chars", "n_symbols", "n_capitals", F.col("l.n").cast("long").alias("n_lines"),
        F.col("l.again").cast("long").alias("n_dup_lines"), "w.n_repeat_words",
    )


def vector() -> list[Column]:
    """The transformed statistics; each is 0 for a text without words."""
    chars, n, lines = (F.greatest(F.col(c), F.lit(1)).cast("double") for c in ("word_chars", "n_words", "n_lines"))
    return [
        F.when(F.col("n_words") > 0, F.log(chars / n)).otherwise(0.0),
        F.log1p(100 * F.col("n_symbols") / chars),
        F.col("n_capitals") / chars,
        F.col("n_dup_lines") / lines,
        F.col("n_repeat_words") / n,
    ]


P = len(FLOOR)


def chi_squared(x: float, k: int) -> float:
    """The distribution function with ``k`` degrees of freedom, by its series."""
    term = total = 1 / math.gamma(k / 2 + 1)
    for n in range(1, 400):
        term *= x / 2 / (k / 2 + n)
        total += term
    return total * (x / 2) ** (k / 2) * math.exp(-x / 2)


def chi_quantile(share: float, k: int) -> float:
    low, high = 0.0, 200.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_squared(middle, k) < share else (low, middle)
    return low


def distance() -> Column:
    """Squared Mahalanobis distance of x0.. from m0.. by the factor l00, l10, l11, ... of the scatter."""
    z: list[Column] = []
    for i in range(P):
        d = F.col(f"x{i}") - F.col(f"m{i}")
        for j in range(i):
            d = d - F.col(f"l{i}{j}") * z[j]
        z.append(d / F.col(f"l{i}{i}"))
    return reduce(lambda a, b: a + b, [v * v for v in z])


def factored(rows: DataFrame) -> DataFrame:
    """Cholesky factor l00, l10, ... of the scatter s00, s10, ..., a column at a time."""
    for j in range(P):
        for i in range(j, P):
            v = F.col(f"s{i}{j}")
            for k in range(j):
                v = v - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            v = F.sqrt(F.greatest(v, F.lit(1e-3 * FLOOR[j] ** 2))) if i == j else v / F.col(f"l{j}{j}")
            rows = rows.withColumn(f"l{i}{j}", v)
    return rows.select("lang", "pool", *[f"m{i}" for i in range(P)], *[f"l{i}{j}" for i in range(P) for j in range(i + 1)])


def estimates(rows: DataFrame, core: float = CORE, steps: int = STEPS, moments_only: bool = False) -> DataFrame:
    """Centre and factored scatter of every ``lang`` and ``pool`` of rows x0, x1, ..., and ``gid``, a hash of both.

    Rows join on the hash and are grouped by the names: so every grouping combines its rows before a shuffle of its own,
    and Spark may split a hot group in the join. With ``moments_only``, the size of the core, centre and scatter as they are.
    """
    group = ["lang", "pool"]
    gid = F.xxhash64(*group).alias("gid")
    rows = rows.select("*", gid)
    middle = [F.percentile_approx(f"x{i}", [0.25, 0.5, 0.75], 2000).alias(f"q{i}") for i in range(P)]
    start = rows.groupBy(*group).agg(*middle)
    start = start.select(
        *group,
        *[F.col(f"q{i}")[1].alias(f"m{i}") for i in range(P)],
        *[
            (F.greatest((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, F.lit(FLOOR[i])) ** 2 if i == j else F.lit(0.0)).alias(f"s{i}{j}")
            for i in range(P)
            for j in range(i + 1)
        ],
    )
    model = stored(factored(start).select("*", gid), "rules-model")
    # rows of the core lie nearer than the rest, so their scatter is too small by this factor
    near = chi_quantile(core, P)
    widen = core / chi_squared(near, P + 2)
    before = None
    for _ in range(steps):
        # distances in steps of a 16th of an octave: the counts of steps give the core exactly, ties included
        far = rows.join(model.drop(*group), "gid").withColumn("far", F.floor(16 * F.log2(distance() + 1e-6)).cast("int"))
        counts = far.groupBy(*group, "far").agg(F.count("*").alias("n"))
        steps_of = F.sort_array(F.collect_list(F.struct("far", "n")))  # some hundred steps at most
        reached = counts.groupBy(*group).agg(steps_of.alias("c"), F.sum("n").alias("all"))
        total = F.aggregate(
            "c",
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("int").alias("far")),
            lambda a, s: F.when(a["n"] < core * F.col("all"), F.struct((a["n"] + s["n"]).alias("n"), s["far"].alias("far"))).otherwise(a),
        )
        reached = stored(reached.select(gid, total["far"].alias("limit")), "rules-core")
        inside = far.join(reached, "gid").where("far <= limit")
        pairs = [(i, j) for i in range(P) for j in range(i + 1)]
        moments = inside.groupBy(*group).agg(
            F.count("*").alias("n"), *[F.avg(f"x{i}").alias(f"m{i}") for i in range(P)], *[F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}{j}") for i, j in pairs]
        )
        scatter = [
            (widen * F.col(f"c{i}{j}") + (F.lit(FLOOR[i] ** 2) if i == j else F.lit(0.0))).alias(f"s{i}{j}") for i, j in pairs
        ]
        held = [F.col("n"), *[F.col(f"m{i}") for i in range(P)], *[F.col(f"s{i}{j}") for i, j in pairs]]
        found = stored(moments.select(*group, "n", *[f"m{i}" for i in range(P)], *scatter), "rules-moments")
        model = stored(factored(found).select("*", gid), "rules-model")
        # sums of the same rows may differ in the last places
        state = F.sum(F.xxhash64(*group, *[F.round(c, 9) for c in held]).cast("decimal(38)"))
        state = found.agg(state.alias("h")).first()["h"]
        if state == before:
            break
        before = state
    return model if not moments_only else found


def drawn(own: DataFrame, whole: DataFrame, core: float = CORE) -> DataFrame:
    """Estimates of every ``pool`` drawn towards those of its language, the latter weighing as ``PRIOR`` rows."""
    share = (F.col("n") / core) / (F.col("n") / core + PRIOR)
    pairs = [(i, j) for i in range(P) for j in range(i + 1)]
    names = [f"m{i}" for i in range(P)] + [f"s{i}{j}" for i, j in pairs]
    both = own.join(whole.select(F.col("lang").alias("l"), *[F.col(c).alias(f"w_{c}") for c in names]), F.col("lang") == F.col("l"))
    # where the centres differ, a mixture of both is wider by that
    gap = {(i, j): share * (1 - share) * (F.col(f"m{i}") - F.col(f"w_m{i}")) * (F.col(f"m{j}") - F.col(f"w_m{j}")) for i, j in pairs}
    mixed = {c: share * F.col(c) + (1 - share) * F.col(f"w_{c}") for c in names}
    mixed |= {f"s{i}{j}": mixed[f"s{i}{j}"] + gap[i, j] for i, j in pairs}
    return both.select("lang", "pool", *[v.alias(c) for c, v in mixed.items()])


def judge(documents: DataFrame) -> DataFrame:
    """Statistics, ``base_failed`` and ``kept`` of every document."""
    rows = measured(documents).select("*", *[x.cast("double").alias(f"x{i}") for i, x in enumerate(vector())])
    rows = stored(rows.withColumn("pool", F.concat(F.lit("="), "source")), "rules-rows")
    # both estimates at once: every row is in the pool of its source and, without a name, in that of its language
    pools = F.explode(F.array("pool", F.lit(""))).alias("pool")
    found = estimates(rows.where("n_words > 0").select("lang", pools, *[f"x{i}" for i in range(P)]), moments_only=True)
    model = factored(drawn(found.where("pool <> ''"), found.where("pool = ''")))
    model = stored(model.select("*", F.xxhash64("lang", "pool").alias("gid")), "rules-model")
    limit = chi_quantile(QUANTILE, P)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    judged = rows.withColumn("gid", F.xxhash64("lang", "pool")).join(model.drop("lang", "pool"), "gid", "left").withColumn("base_failed", failed)
    near = F.coalesce(distance() <= limit, F.lit(False))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & near).alias("kept"),
    )
