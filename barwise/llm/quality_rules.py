"""Quality rules: fixed limits, then robust multivariate outliers per language and source.

A document that passes the fixed limits is described by four transformed
statistics. For each (language, source) pool, minimum-covariance-determinant
estimates of location and scatter are found by concentration steps, and
documents with a large Mahalanobis distance are rejected.

All work is DataFrame functions. One pass computes the statistics and stores
them with the rows; each concentration step is one aggregate of moments per
pool and distance bin (at most ``BINS`` rows a pool leave a task, so a hot
source is pre-aggregated), and the half-set is the bins up to the wanted share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwise.llm.scratch import stored
from barwise.llm.textstats import with_statistics
from barwise.operators.joins import bounded_broadcast

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
# Share of a pool that the estimate rests on, and the concentration steps from
# the median and quartile start (distances change by under a percent after 3).
SHARE, STEPS, BINS = 0.75, 4, 256
# A determinant from the central 75 % understates a normal scatter by about this factor.
CONSISTENCY = 1.3
# Resolution of each statistic: its scatter is never taken to be finer.
FLOORS = (0.06, 0.03, 0.03, 0.15)
# Texts this short have half the weight: deviations shrink by sqrt(n / (n + this)).
STEADY_WORDS = 100
# Chi-squared with four degrees of freedom exceeds this with probability 1e-7.
CUT = 38.2
# Fewer documents than this join the pool of their language, or of the rest.
MIN_POOL = 50
# Stored keys of rejected rows are broadcast up to this size; beyond, the rows are shuffled to them.
SENT_BYTES = 24 << 20
D = 4


def base_failed(s: Column) -> Column:
    """The fixed limits on the statistics struct."""
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])


def _vector(s: Column) -> list[Column]:
    """Log mean word length, root symbol share, arcsine root share of
    characters that are no letters, root share of repeated words."""
    words, chars = F.greatest(s["n_words"], F.lit(1)), F.greatest(s["word_chars"], F.lit(1))
    share = lambda x: F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))
    return [F.log(chars / words), F.sqrt(s["n_symbols"] / chars),
            F.asin(F.sqrt(share(1 - s["n_letters"] / chars))), F.sqrt(share(s["n_repeat_words"] / words))]


def _pools(rows: DataFrame) -> DataFrame:
    """lang, source, pool: small cells share their language's pool, small rests one pool."""
    cells = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    cells = cells.withColumn("own", F.col("n") >= MIN_POOL)
    rest = F.sum(F.when(~F.col("own"), F.col("n"))).over(Window.partitionBy("lang"))
    level = F.when(F.col("own"), 0).when(rest >= MIN_POOL, 1).otherwise(2)
    name = F.to_json(F.struct(level.alias("level"), F.when(level < 2, F.col("lang")).alias("lang"),
                              F.when(level == 0, F.col("source")).alias("source")))
    return cells.select("lang", "source", name.alias("pool"))


def _center(rows: DataFrame) -> DataFrame:
    """Per pool: size, and median and quartile scale of each statistic."""
    q = [F.percentile_approx(f"x{i}", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 2000).alias(f"q{i}") for i in range(D)]
    p = rows.groupBy("pool").agg(F.count(F.lit(1)).alias("n"), *q).filter(F.col("n") >= MIN_POOL)
    return p.select("pool", "n", *[F.col(f"q{i}")[1].alias(f"c{i}") for i in range(D)],
                    *[F.lit(0.0).alias(f"m{i}") for i in range(D)],
                    *[(F.greatest((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, F.lit(FLOORS[i])) if i == j else F.lit(0.0))
                      .alias(f"l{i}{j}") for i in range(D) for j in range(i + 1)])


def _deviations(n_words: Column) -> list[Column]:
    """Length-steadied deviations from the pool's medians."""
    weight = F.sqrt(n_words / (n_words + STEADY_WORDS))
    return [(F.col(f"x{i}") - F.col(f"c{i}")) * weight for i in range(D)]


def _distance(y: list[Column]) -> Column:
    """Squared Mahalanobis distance by forward substitution through the Cholesky factor l."""
    z: list[Column] = []
    for i in range(D):
        v = y[i] - F.col(f"m{i}")
        for j in range(i):
            v = v - F.col(f"l{i}{j}") * z[j]
        z.append(v / F.col(f"l{i}{i}"))
    return sum((v * v for v in z[1:]), z[0] * z[0])


def _concentrate(rows: DataFrame, params: DataFrame) -> DataFrame:
    """One concentration step: estimates from the nearest ``SHARE`` of each pool."""
    devs = rows.join(bounded_broadcast(params), "pool")  # a row per pool; unsent, documents would be dealt by pool
    devs = devs.withColumns({f"y{i}": y for i, y in enumerate(_deviations(F.col("n_words")))})
    d = _distance([F.col(f"y{i}") for i in range(D)])
    devs = devs.withColumn("bin", F.least(F.floor(F.log1p(d) * 24), F.lit(BINS - 1)).cast("int"))
    sums = [F.sum(f"y{i}").alias(f"s{i}") for i in range(D)]
    sums += [F.sum(F.col(f"y{i}") * F.col(f"y{j}")).alias(f"s{i}{j}") for i in range(D) for j in range(i + 1)]
    # Written first, so that the windows below read at most BINS rows a pool, not a task's share each.
    bins = stored(devs.groupBy("pool", "bin").agg(F.count(F.lit(1)).alias("k"), *sums), "bins")
    before = F.coalesce(F.sum("k").over(Window.partitionBy("pool").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = F.sum("k").over(Window.partitionBy("pool"))
    near = bins.withColumn("before", before).withColumn("whole", whole).filter(F.col("before") < SHARE * F.col("whole"))
    total = near.groupBy("pool").agg(F.sum("k").alias("k"), *[F.sum(c).alias(c) for c in bins.columns if c[0] == "s"])
    total = total.withColumns({f"m{i}": F.col(f"s{i}") / F.col("k") for i in range(D)})
    cov = {}
    for i in range(D):
        for j in range(i + 1):
            c = (F.col(f"s{i}{j}") / F.col("k") - F.col(f"m{i}") * F.col(f"m{j}")) * CONSISTENCY
            cov[f"v{i}{j}"] = F.greatest(c, F.lit(0.0)) + FLOORS[i] ** 2 if i == j else c
    total = total.withColumns(cov)
    for i in range(D):  # Cholesky, a column of the factor at a time
        for j in range(i + 1):
            v = F.col(f"v{i}{j}")
            for k in range(j):
                v = v - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            total = total.withColumn(f"l{i}{j}", F.sqrt(F.greatest(v, F.lit(FLOORS[i] ** 2 * 0.01))) if i == j else v / F.col(f"l{j}{j}"))
    new = total.select("pool", *[f"m{i}" for i in range(D)], *[f"l{i}{j}" for i in range(D) for j in range(i + 1)])
    return params.select("pool", "n", *[f"c{i}" for i in range(D)]).join(new, "pool")


def judge(pairs: DataFrame) -> DataFrame:
    """For ``pairs`` (doc: any payload; text, lang, source): doc, s (statistics),
    base_failed, distance (null without an estimate), kept.

    Null texts count as empty and fail the limits, as do texts of fewer than
    ten words. Null languages and sources are pools like any other. A pool of
    fewer than ``MIN_POOL`` documents in the end has no estimate: the fixed
    limits decide alone. Repeated rows are judged alike; ties in distance fall
    into one bin. Empty tables give no rows.
    """
    rows = with_statistics(pairs, "text", "s").drop("text").withColumn("base_failed", base_failed(F.col("s")))
    rows = stored(rows.withColumns({f"x{i}": x for i, x in enumerate(_vector(F.col("s")))}), "statistics")
    good = rows.filter("not base_failed").select("lang", "source", F.col("s.n_words").alias("n_words"), *[f"x{i}" for i in range(D)])
    pools = bounded_broadcast(stored(_pools(good), "pools"))
    cell = lambda left: (left["lang"].eqNullSafe(pools["lang"])) & (left["source"].eqNullSafe(pools["source"]))
    pooled = good.join(pools, cell(good)).drop("lang", "source")
    params = stored(_center(pooled), "estimates")
    for _ in range(STEPS):
        params = stored(_concentrate(pooled, params), "estimates")
    judged = rows.join(pools, cell(rows), "left").drop(pools["lang"]).drop(pools["source"]).join(bounded_broadcast(params), "pool", "left")
    distance = F.when(~F.col("base_failed"), _distance(_deviations(F.col("s.n_words"))))
    judged = judged.withColumn("distance", distance)
    kept = ~F.col("base_failed") & ~F.coalesce(F.col("distance") > CUT, F.lit(False))
    return judged.select("doc", "s", "base_failed", "distance", kept.alias("kept"))


def verdicts(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, distance; see ``judge``."""
    pairs = docs.select(F.col("doc_id").cast("long").alias("doc"), "text", "lang", "source")
    return judge(pairs).select(F.col("doc").alias("doc_id"), "s.n_words", "s.word_chars", "s.n_symbols", "s.n_dup_lines",
                               "s.n_repeat_words", "base_failed", "kept", "distance")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that are kept, all columns as they were.

    Texts are not written anywhere: rows are judged under a 128-bit hash of
    id, text, language and source, and those rejected are taken out by it
    (broadcast while few enough, see ``SENT_BYTES``).
    """
    sign = lambda seed: F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"), F.isnull("text"), F.col("lang"), F.isnull("lang"), F.col("source"), F.isnull("source"))
    pairs = docs.select(F.struct(sign(1).alias("_h1"), sign(2).alias("_h2")).alias("doc"), F.col("text").alias("text"), F.col("lang").alias("lang"), F.col("source").alias("source"))
    gone = stored(judge(pairs).filter("not kept").select("doc._h1", "doc._h2").distinct(), "rejected")
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), sign(1).alias("_h1"), sign(2).alias("_h2"))
    gone = bounded_broadcast(gone.withColumnsRenamed({"_h1": "_g1", "_h2": "_g2"}), SENT_BYTES)
    # One long as the key, the other half as a condition: a broadcast table over a long takes a fraction of the memory.
    return marked.join(gone, (F.col("_h1") == F.col("_g1")) & (F.col("_h2").bitwiseXOR(F.col("_g2")) == 0), "left_anti").select("doc.*")
