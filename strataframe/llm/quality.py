"""Quality rules: base rules, then robust multivariate outliers per language and source.

Only DataFrame functions are used.  Each document that passes the base rules has five
transformed statistics.  Per group (language and source) a minimum-covariance-determinant estimate is found by
C-steps from two deterministic starts and re-weighted once.  Its moments are then mixed with those
of the language, as ``PRIOR_ROWS`` rows of it would, and the language's likewise with those of all
rows: a small group is judged nearly like its language, a large one by itself, and no number of
rows switches between the two.  Documents with a large Mahalanobis distance are rejected.  Every C-step is one aggregate over all rows: moments are summed per bin of the
distance, and the bins up to the wanted share make up the next subset.

Null texts count as empty, null languages and sources are groups of their own, repeated rows
are judged alike, an empty table gives an empty result, columns other than doc_id, text, lang
and source are neither read nor returned.  Floating sums are rounded before use, so reruns agree.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataframe.llm.common import staged, words_of
from strataframe.session import broadcast_if_small, cut_lineage, is_small

SYMBOLS = "#*$%&|<>"
STATS = ["word_length", "symbols", "capitals", "line_length", "repeats"]
D = len(STATS)
PAIRS = [(i, j) for i in range(D) for j in range(i + 1)]
# deviations below these are never outlying: they keep constant statistics from having no spread
FLOOR = [0.05, 0.04, 0.06, 0.25, 0.10]
# chi-square with 5 degrees of freedom: share of rows kept by the subset, by the re-weighting, and
# the factors that make covariances of the kept rows consistent at the normal distribution
SUBSET_SHARE, SUBSET_FACTOR = 0.75, 1.411
REWEIGHT_LIMIT, REWEIGHT_FACTOR = 12.83, 1.055
PRIOR_ROWS = 200  # as many rows of its own weigh as much in a group as its language does


def repeated_words(words: Column) -> Column:
    """How many words lie in a three-word window that is found twice or more in the text.

    Windows are sorted by a hash with the place in its low bits; places whose neighbour has the
    same hash are compared by their words, so a shared hash alone never counts.
    """
    n = F.size(words)
    keys = F.transform(
        F.slice(words, 1, F.greatest(n - 2, F.lit(0))),
        lambda w, i: F.shiftleft(F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)), 30).bitwiseOR(i.cast("long")),
    )
    low = F.lit((1 << 30) - 1)

    def covered(k: Column) -> Column:
        same = lambda v, i: v.bitwiseXOR(F.get(k, i)).between(F.lit(0), low)
        near = F.transform(F.filter(k, lambda v, i: same(v, i + 1) | same(v, i - 1)), lambda v: v.bitwiseAND(low).cast("int"))
        spelled = F.array_sort(F.transform(near, lambda p: F.struct(F.array_join(F.slice(words, p + 1, 3), " ").alias("w"), p.alias("p"))))

        def places(s: Column) -> Column:
            twice = F.filter(s, lambda v, i: (v["w"] == F.get(s, i + 1)["w"]) | (v["w"] == F.get(s, i - 1)["w"]))
            return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda v: F.sequence(v["p"], v["p"] + 2)))))

        return bound(spelled, places)

    return F.when(n < 4, F.lit(0)).otherwise(bound(F.sort_array(keys), covered)).cast("long")


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once although lambdas below refer to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def base_rules(docs: DataFrame, *carry: str) -> DataFrame:
    """Counts, the base verdict and the transformed statistics of every document; ``carry`` names columns kept."""
    text = F.coalesce(F.col("text"), F.lit(""))
    only = lambda chars: F.length(F.regexp_replace(text, f"[^{chars}]+", "")).cast("long")
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    raw = docs.select(
        *carry, "lang", "source",
        words_of(F.col("text")).alias("_words"), lines.alias("_lines"),
        only(SYMBOLS.replace("|", r"\|").replace("$", r"\$")).alias("n_symbols"), only("A-Z").alias("_capitals"),
    )
    counted = raw.select(
        *carry, "lang", "source", "n_symbols", "_capitals",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").alias("_n_lines"),
        repeated_words(F.col("_words")).alias("n_repeat_words"),
    )
    n, chars = F.col("n_words"), F.col("word_chars")
    share = lambda part, whole: F.sqrt(F.try_divide(part, whole))
    stats = [
        F.log(F.try_divide(chars, n)), share(F.col("n_symbols"), chars), share(F.col("_capitals"), chars),
        F.log(F.try_divide(n, F.col("_n_lines"))), share(F.col("n_repeat_words"), n),
    ]
    return counted.select(
        *carry, "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((n < 50) | (F.lit(100) * F.col("n_repeat_words") > 50 * n)).alias("base_failed"),
        *[F.round(s, 6).alias(f"x{i}") for i, s in enumerate(stats)],
    )


def _keys() -> Column:
    """The groups a row belongs to, the finest first."""
    lang, source = (F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-")) for c in ("lang", "source"))
    return F.array(F.concat_ws("\x00", lang, source), lang, F.lit("*"))


def _offsets() -> list[Column]:
    return [F.col(f"x{i}") - F.col(f"m{i}") for i in range(D)]


def _distance() -> Column:
    """Squared Mahalanobis distance of a row from the fit that is joined to it."""
    x = _offsets()
    return reduce(Column.__add__, [F.pow(reduce(Column.__add__, [F.col(f"w{i}{j}") * x[j] for j in range(i + 1)]), 2) for i in range(D)])


def _fit(moments: DataFrame, factor: float, keys: list[str]) -> DataFrame:
    """Means, the inverse Cholesky factor of the covariance and its log determinant from sums of values and products."""
    n = F.col("n")
    out = moments.select(*keys, "n", *[F.round(F.col(f"s{i}") / n, 9).alias(f"m{i}") for i in range(D)], *[f"p{i}{j}" for i, j in PAIRS])
    floor = lambda i, j: F.lit(FLOOR[i] ** 2 if i == j else 0.0)
    out = out.select(
        *keys, "n", *[f"m{i}" for i in range(D)],
        *[(F.round(F.lit(factor) * (F.col(f"p{i}{j}") / n - F.col(f"m{i}") * F.col(f"m{j}")), 9) + floor(i, j)).alias(f"c{i}{j}") for i, j in PAIRS],
    )
    minus = lambda i, j: reduce(Column.__sub__, [F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)], F.col(f"c{i}{j}"))
    for j in range(D):  # Cholesky, column by column
        out = out.withColumn(f"l{j}{j}", F.sqrt(F.greatest(minus(j, j), F.lit(1e-12))))
        out = out.withColumns({f"l{i}{j}": minus(i, j) / F.col(f"l{j}{j}") for i in range(j + 1, D)})
    for i in range(D):  # inverse of the factor, row by row
        above = lambda j: -reduce(Column.__add__, [F.col(f"l{i}{k}") * F.col(f"w{k}{j}") for k in range(j, i)])  # noqa: E731, B023
        out = out.withColumns({f"w{i}{j}": (F.lit(1.0) if i == j else above(j)) / F.col(f"l{i}{i}") for j in range(i + 1)})
    logdet = reduce(Column.__add__, [F.log(F.col(f"l{i}{i}")) for i in range(D)])
    return out.select(*keys, "n", *[f"m{i}" for i in range(D)], *[f"w{i}{j}" for i, j in PAIRS], F.round(logdet, 6).alias("logdet"))


def _sums(*x: Column) -> list[Column]:
    values = [F.sum(x[i]).alias(f"s{i}") for i in range(D)]
    return [F.count(F.lit(1)).alias("n"), *values, *[F.sum(x[i] * x[j]).alias(f"p{i}{j}") for i, j in PAIRS]]


def _medians(rows: DataFrame, values: list[Column], name: str) -> DataFrame:
    """Median of each value per key, to three digits, from counts per bin."""
    bins = rows.select("key", F.posexplode(F.array(*[F.round(v * 1000).cast("long") for v in values])).alias("dim", "bin"))
    counts = bins.groupBy("key", "dim", "bin").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("key", "dim")
    counts = counts.select("key", "dim", "bin", F.sum("n").over(w.orderBy("bin")).alias("upto"), F.sum("n").over(w).alias("total"))
    halves = counts.filter(F.col("upto") * 2 >= F.col("total")).groupBy("key", "dim").agg(F.min("bin").alias("bin"))
    return halves.groupBy("key").agg(*[F.max(F.when(F.col("dim") == i, F.col("bin") / 1000.0)).alias(f"{name}{i}") for i in range(D)])


def _mixed_down(sums: DataFrame) -> DataFrame:
    """The moments of every key with ``PRIOR_ROWS`` rows' worth of its parent's, from the root down."""
    names = ["n", *[f"s{i}" for i in range(D)], *[f"p{i}{j}" for i, j in PAIRS]]
    group, root = F.contains("key", F.lit("\x00")), F.col("key") == "*"
    above = sums.filter(root)
    out = [above.select("key", *names)]
    for level in (~group & ~root, group):
        parent = F.when(group, F.substring_index("key", "\x00", 1)).otherwise(F.lit("*"))
        own = sums.filter(level).withColumn("_up", parent)
        prior = above.select(F.col("key").alias("_up"), *[(F.col(c) / F.col("n")).alias(f"_{c}") for c in names])
        above = cut_lineage(own.join(prior, "_up").select("key", *[(F.col(c) + F.lit(float(PRIOR_ROWS)) * F.col(f"_{c}")).alias(c) for c in names]))
        out.append(above)
    return out[0].unionByName(out[1]).unionByName(out[2])


def fit_groups(rows: DataFrame, c_steps: int) -> DataFrame:
    """A robust centre and scatter for every group, for every language and for all rows together."""
    keyed = rows.select(F.explode(_keys()).alias("key"), *[f"x{i}" for i in range(D)])
    keys = cut_lineage(keyed.select("key").distinct())
    # all tables joined below have a row or two for each of these groups
    hint = F.broadcast if is_small(keys, max_rows=50_000) else (lambda df: df)
    centre = cut_lineage(_medians(keyed, [F.col(f"x{i}") for i in range(D)], "m"))
    spread = _medians(keyed.join(hint(centre), "key"), [F.abs(v) for v in _offsets()], "a")
    scale = cut_lineage(centre.join(spread, "key").select("key", *[f"m{i}" for i in range(D)], *[(1.4826 * F.col(f"a{i}") + FLOOR[i]).alias(f"a{i}") for i in range(D)]))

    # one start takes the rows nearest the medians, the other the covariance of squashed values
    unit = [F.lit(1.0) / F.col(f"a{i}") if i == j else F.lit(0.0) for i, j in PAIRS]
    nearest = scale.select("key", F.lit("nearest").alias("start"), *[f"m{i}" for i in range(D)], *[u.alias(f"w{i}{j}") for u, (i, j) in zip(unit, PAIRS)])
    z = [F.tanh(v / F.col(f"a{i}")) for i, v in enumerate(_offsets())]
    squashed = _fit(keyed.join(hint(scale), "key").groupBy("key").agg(*_sums(*z)), 1.0, ["key"])
    squashed = squashed.drop(*[f"m{i}" for i in range(D)]).join(scale, "key").select(
        "key", F.lit("squashed").alias("start"), *[f"m{i}" for i in range(D)], *[(F.col(f"w{i}{j}") / F.col(f"a{j}")).alias(f"w{i}{j}") for i, j in PAIRS]
    )
    fits = cut_lineage(nearest.unionByName(squashed))
    for _ in range(c_steps):
        bins = (
            keyed.join(hint(fits), "key")
            .groupBy("key", "start", F.floor(F.log1p(F.least(_distance(), F.lit(1e12))) * 64).alias("bin"))
            .agg(*_sums(*[F.col(f"x{i}") for i in range(D)]))
        )
        w = Window.partitionBy("key", "start")
        names = ["n", *[f"s{i}" for i in range(D)], *[f"p{i}{j}" for i, j in PAIRS]]
        upto = bins.select("key", "start", "bin", F.sum("n").over(w).alias("total"), *[F.sum(c).over(w.orderBy("bin")).alias(c) for c in names])
        subset = upto.filter(F.col("n") >= F.col("total") * SUBSET_SHARE).groupBy("key", "start").agg(F.min_by(F.struct(*names), "bin").alias("s"))
        fits = cut_lineage(_fit(subset.select("key", "start", "s.*"), SUBSET_FACTOR, ["key", "start"]))
    best = fits.groupBy("key").agg(F.min_by(F.struct(*[c for c in fits.columns if c != "key"]), F.struct("logdet", "start")).alias("f")).select("key", "f.*")
    inner = keyed.join(hint(cut_lineage(best)), "key").filter(_distance() <= REWEIGHT_LIMIT)
    sums = cut_lineage(inner.groupBy("key").agg(*_sums(*[F.col(f"x{i}") for i in range(D)])))
    return cut_lineage(_fit(_mixed_down(sums), REWEIGHT_FACTOR, ["key"]))


def quality_rules(docs: DataFrame, *carry: str, c_steps: int = 3, limit: float = 40.0) -> DataFrame:
    """Counts, base verdict, distance and verdict per document.

    ``limit`` bounds the squared distance; it lies far above the 0.9999 quantile (25.7) of normal
    statistics, since texts have heavier tails.
    """
    rows = staged(base_rules(docs, *carry), "quality")
    judged = rows.filter(~F.col("base_failed"))
    fits = fit_groups(judged, c_steps)
    fits = fits.select("key", F.struct(*[c for c in fits.columns if c != "key"]).alias("f"))
    keys = _keys()
    known = rows.withColumn("_k", keys[0])  # a group whose rows all failed has no fit and needs none
    chosen = known.join(broadcast_if_small(fits.withColumnRenamed("key", "_k")), "_k", "left").select(*rows.columns, "f.*")
    distance = F.when(~F.col("base_failed"), F.round(_distance(), 6))
    out = chosen.select(*rows.columns, distance.alias("distance"))
    return out.select(
        *carry, "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= limit)).alias("kept"), "distance",
        *[f"x{i}" for i in range(D)],
    )
