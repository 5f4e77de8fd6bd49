"""Quality rules: fixed limits, then robust multivariate outliers per language and source.

Every text is measured; two base rules reject at fixed limits. The documents that pass are
compared with those of their own language and source: four transformed statistics (log mean word
length, log symbol density, share of repeated lines, share of capitals) are held against a
minimum-covariance-determinant estimate of the group, and a document whose squared Mahalanobis
distance exceeds the limit is rejected.

The estimate is the deterministic one: it starts from medians and absolute deviations, and
each concentration step takes mean and covariance of the three quarters of the group that lie nearest
to the estimate before. Every step is a grouped aggregation, combined before its shuffle, so a
group of any size is never in one task. The covariance gets a fixed floor on its diagonal, since
most texts have no symbol and no repeated line at all. A group under ``MIN_GROUP`` documents is
held against all documents of its language that pass the base rules, large groups included, and where these are too few, against all that pass.

Nulls and odd cases: a null text counts as empty and fails the base rules; a null language or source
is a group of its own; repeated rows are measured and returned each. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm import common

WINDOW = 8
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\f\r"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

FEATURES = ("f_length", "f_symbols", "f_lines", "f_capitals")
# Least standard deviation of each transformed statistic.
FLOORS = (0.1, 1.0, 0.15, 0.15)
CENTRAL = 0.75
# The central three quarters of a normal cloud in four dimensions understate its covariance by this factor.
CONSISTENCY = 1.485
# The 0.999 quantile of the squared distance for a normal cloud in four dimensions.
LIMIT = 18.47
STEPS = 3
MIN_GROUP = 50


def _stripped_length(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def measures(docs: DataFrame) -> DataFrame:
    """The rows with their counts; texts stay out of the result."""
    keep = ["doc_id", "lang", "source"]
    rows = docs.select(*keep, F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("*", common.words(F.col("text")).alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select(
        *keep,
        "text",
        F.size("words").cast("long").alias("n_words"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
        lines.alias("lines"),
    )
    window = F.transform(
        F.sequence(F.lit(0), (F.col("n_words") - WINDOW).cast("int")),
        lambda i: F.xxhash64(*[F.get("hashes", i + j) for j in range(WINDOW)]),
    )
    rows = rows.select(
        *keep,
        "n_words",
        _stripped_length(F.col("text"), BLANKS).cast("long").alias("word_chars"),
        (F.length("text") - _stripped_length(F.col("text"), SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("n_words") >= WINDOW, window).otherwise(F.array().cast("array<bigint>")).alias("windows"),
    )
    counts = [c for c in rows.columns if c != "windows"]
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    rows = rows.select(*counts, F.when(repeats, placed).alias("placed"))
    # Windows that stand beside an equal one in the sorted order, back in the order of the text.
    starts = F.filter("placed", _has_twin)
    starts = F.array_sort(F.transform(starts, lambda x: x["at"]))
    rows = rows.select(*counts, starts.alias("starts"))
    gap = lambda x, i: F.when(i == 0, WINDOW).otherwise(F.least(F.lit(WINDOW), x - F.get("starts", i - 1)))
    covered = F.aggregate(F.transform("starts", gap), F.lit(0), lambda a, x: a + x)
    return rows.select(*counts, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def _has_twin(x: Column, i: Column) -> Column:
    before = F.coalesce(F.get("placed", i - 1)["h"] == x["h"], F.lit(False))
    return before | F.coalesce(F.get("placed", i + 1)["h"] == x["h"], F.lit(False))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def transformed() -> dict[str, Column]:
    characters = F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "f_length": F.log((F.col("word_chars") + 1) / (F.col("n_words") + 1)),
        "f_symbols": F.log1p(1000 * F.col("n_symbols") / characters),
        "f_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "f_capitals": F.col("n_capitals") / characters,
    }


def _cholesky(mean: list[Column], cov: dict[tuple[int, int], Column]) -> list[Column]:
    """Columns m0.. and l00.. of the estimate: the mean and the lower triangular root of the covariance."""
    n, low = len(mean), {}
    for i in range(n):
        for j in range(i + 1):
            rest = cov[i, j]
            for k in range(j):
                rest = rest - low[i, k] * low[j, k]
            low[i, j] = F.sqrt(F.greatest(rest, F.lit(FLOORS[i] ** 2))) if i == j else rest / low[j, j]
    return [c.alias(f"m{i}") for i, c in enumerate(mean)] + [c.alias(f"l{i}{j}") for (i, j), c in low.items()]


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution."""
    z: list[Column] = []
    for i, name in enumerate(FEATURES):
        rest = F.col(name) - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * z[j]
        z.append(rest / F.col(f"l{i}{i}"))
    return sum((x * x for x in z[1:]), z[0] * z[0])


def _estimates(rows: DataFrame) -> DataFrame:
    """One row per group with mean and covariance root of its central documents."""
    pairs = [(i, j) for i in range(len(FEATURES)) for j in range(i + 1)]
    medians = rows.groupBy("group").agg(*[F.percentile_approx(f, 0.5).alias(f"m{i}") for i, f in enumerate(FEATURES)])
    off = [F.percentile_approx(F.abs(F.col(f) - F.col(f"m{i}")), 0.5).alias(f"s{i}") for i, f in enumerate(FEATURES)]
    spread = rows.join(medians, "group").groupBy("group").agg(*[F.first(f"m{i}").alias(f"m{i}") for i in range(4)], *off)
    root = {(i, j): F.greatest(F.col(f"s{i}") * 1.4826, F.lit(FLOORS[i])) if i == j else F.lit(0.0) for i, j in pairs}
    first = [F.col(f"m{i}") for i in range(4)] + [c.alias(f"l{i}{j}") for (i, j), c in root.items()]
    estimate = common.written(spread.select("group", *first), "estimates")
    for _ in range(STEPS):
        placed = rows.join(estimate, "group").select("group", *FEATURES, _distance().alias("distance"))
        reach = placed.groupBy("group").agg(F.percentile_approx("distance", CENTRAL).alias("reach"))
        central = placed.join(reach, "group").filter("distance <= reach")
        moments = central.groupBy("group").agg(
            *[F.avg(f).alias(f"m{i}") for i, f in enumerate(FEATURES)],
            *[F.covar_pop(FEATURES[i], FEATURES[j]).alias(f"c{i}{j}") for i, j in pairs],
        )
        cov = {(i, j): CONSISTENCY * F.col(f"c{i}{j}") for i, j in pairs}
        for i in range(4):
            cov[i, i] = cov[i, i] + FLOORS[i] ** 2
        roots = _cholesky([F.col(f"m{i}") for i in range(4)], cov)
        estimate = common.written(moments.select("group", *roots), "estimates")
    return estimate


def judge(docs: DataFrame) -> DataFrame:
    """The measures of every row with base_failed, the squared distance (null without a verdict) and kept."""
    rows = measures(docs).withColumn("base_failed", base_failed()).withColumns(transformed())
    # As JSON, a null language or source is a value like any other.
    names = {"own": F.to_json(F.struct("lang", "source")), "pool": F.to_json(F.struct("lang"))}
    rows = common.written(rows.withColumns(names), "measures")
    sound = rows.filter(~F.col("base_failed"))
    sizes = sound.groupBy("own", "pool").agg(F.count(F.lit(1)).alias("n"))
    small = F.col("n") < MIN_GROUP
    pools = sizes.groupBy("pool").agg(F.sum("n").alias("pooled"), F.max(small).alias("wanted"))
    own, pool, every = F.concat(F.lit("own "), "own"), F.concat(F.lit("pool "), "pool"), F.lit("all")
    enough = F.col("pooled") >= MIN_GROUP
    group = F.when(~small, own).when(enough, pool).otherwise(every)
    # The estimates that a group's documents enter: its own, and those that some small group needs.
    enters = [F.when(~small, own), F.when(F.col("wanted") & enough, pool)]
    if not pools.filter("wanted").filter(~enough).isEmpty():
        enters.append(every)
    groups = sizes.join(pools, "pool").select("own", group.alias("group"), F.array_compact(F.array(*enters)).alias("enters"))
    groups = common.written(groups, "groups")
    members = sound.join(groups.drop("group"), "own").select(F.explode("enters").alias("group"), *FEATURES)
    groups = groups.drop("enters")
    estimates = groups.join(_estimates(common.written(members, "members")), "group").drop("group")
    judged = rows.join(estimates, "own", "left")
    distance = F.when(~F.col("base_failed"), _distance())
    kept = ~F.col("base_failed") & ~F.coalesce(F.col("distance") > LIMIT, F.lit(False))
    return judged.withColumn("distance", distance).withColumn("kept", kept)
