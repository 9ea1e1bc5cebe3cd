"""Quality rules: robust multivariate outliers per language and source.

A document's statistics are transformed to a vector; each (language, source)
group gets a minimum-covariance-determinant estimate: the mean and covariance
of the half-and-more of its documents whose spread is least, found by
concentration steps from two deterministic starts. Each step keeps the share
``KEEP`` of smallest Mahalanobis distances and re-estimates from it; the start
with the smaller determinant wins. The covariance that judges is then estimated
anew from all documents of the group within ``CUTOFF`` of that start, so the
group's own spread decides what is far. Groups with few documents use the estimate of
their language, or of all documents. A document is rejected when its distance,
given its length, is beyond ``CUTOFF``.

Per-group work is partial sums and histograms, so a group that holds most of
the rows is spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from refinery.llm.common import let, stored

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
#: Vector: log length first, then what is judged given the length.
DIMS = ("length", "word_length", "symbols", "repeats", "dup_lines")
#: Variance that every dimension has at least: most groups' inner part has no symbols or
#: repeats at all, which would make the covariance singular. One symbol, one 3-word window
#: that occurs twice or one duplicate line in 50 words reject nothing alone.
FLOORS = (0.05 ** 2, 0.06 ** 2, 0.18 ** 2, 0.42 ** 2, 0.18 ** 2)
KEEP = 0.65             # share of a group that the subset of least determinant holds
STEPS = 3               # concentration steps per start
MIN_GROUP = 200         # smaller groups use a wider one's estimate
#: Squared distance of 4 dimensions; chi-square with 4 degrees: 1 in 10^7 beyond 38.2.
CUTOFF = 38.2
SALTS = 32              # parts of a group that is dealt out
CHI_MEDIAN = 3.3567     # median of chi-square with 4 degrees of freedom


def base_statistics(text: Column) -> Column:
    """struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    def repeated(words: Column) -> Column:
        """Words in 3-word windows that occur twice or more: windows sorted by hash, neighbours
        compared, then the stretches that the marked starts cover are summed."""
        hashed = F.transform(words, lambda w: F.xxhash64(w))
        windows = let(hashed, lambda h: F.sort_array(F.transform(
            F.sequence(F.lit(0), F.size(h) - 3),
            lambda i: F.struct(F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2)).alias("h"), i.alias("i")))))
        starts = let(windows, lambda ws: F.sort_array(F.transform(F.filter(
            ws, lambda x, k: (x["h"] == F.get(ws, k - 1)["h"]) | (x["h"] == F.get(ws, k + 1)["h"])),
            lambda x: x["i"])))
        covered = let(starts, lambda s: F.aggregate(
            F.transform(s, lambda i, k: F.least(F.lit(3), F.coalesce(F.get(s, k + 1) - i, F.lit(3)))),
            F.lit(0), lambda a, n: a + n))
        return F.when(F.size(words) < 4, 0).otherwise(covered)

    def all_of(t: Column) -> Column:
        words = F.filter(F.split(t, SPACE), lambda w: w != "")
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        return let(words, lambda ws: F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.length(F.regexp_replace(t, SPACE, "")).cast("long").alias("word_chars"),
            (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            let(lines, lambda ls: F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            repeated(ws).cast("long").alias("n_repeat_words")))
    return let(text, all_of)


def _vector() -> list[Column]:
    n = F.col("n_words")

    def rate(c: str) -> Column:
        return F.log1p(100.0 * F.col(c) / n)
    return [F.log(n.cast("double")), F.log(F.col("word_chars") / n), rate("n_symbols"),
            rate("n_repeat_words"), rate("n_dup_lines")]


def _moments(rows: DataFrame, by: list[str], weight: Column | None = None) -> DataFrame:
    """Group sizes, means and Cholesky factors of the covariance, variances raised to ``FLOORS``."""
    p = len(DIMS)
    if weight is not None:
        rows = rows.where(weight)
    x = [F.col(f"x{i}") for i in range(p)]
    sums = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(x[i]).alias(f"m{i}") for i in range(p)],
        *[F.avg(x[i] * x[j]).alias(f"s{i}{j}") for i in range(p) for j in range(i, p)])
    cov = {(i, j): F.col(f"s{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}") for i in range(p) for j in range(i, p)}
    out = sums.withColumns({f"c{i}{j}": F.greatest(c, F.lit(FLOORS[i])) if i == j else c for (i, j), c in cov.items()})
    for j in range(p):          # columns of the factor; each refers to earlier ones by name
        diag = F.col(f"c{j}{j}") - sum((F.col(f"l{j}{k}") ** 2 for k in range(j)), F.lit(0.0))
        out = out.withColumn(f"l{j}{j}", F.sqrt(F.greatest(diag, F.lit(FLOORS[j] / 2))))
        if j + 1 < p:
            out = out.withColumns({f"l{i}{j}": (F.col(f"c{j}{i}") - sum(
                (F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))) / F.col(f"l{j}{j}")
                for i in range(j + 1, p)})
    det = sum((F.log(F.col(f"l{j}{j}")) for j in range(p)), F.lit(0.0))
    return out.select(*by, "n", det.alias("det"), *[f"m{i}" for i in range(p)],
                      *[f"l{i}{j}" for i in range(p) for j in range(i + 1)])


def _spread(rows: DataFrame, groups: DataFrame, by: list[str]) -> DataFrame:
    """Rows joined to their group's values. Where the groups are too many to be broadcast, each
    group's rows are dealt over ``SALTS`` tasks."""
    salted = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return (rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
            .join(salted, [*by, "_salt"]).drop("_salt"))


def _distances(rows: DataFrame, est: DataFrame, by: list[str]) -> DataFrame:
    """rows with d2 (squared distance) and d2_given (without the length's part)."""
    kept = rows.columns
    j = _spread(rows, est.select(*by, *[c for c in est.columns if c[0] in "ml" and c[1:].isdigit()]), by)
    z = []
    for i in range(len(DIMS)):
        name = f"z{i}"
        j = j.withColumn(name, (F.col(f"x{i}") - F.col(f"m{i}") - sum(
            (F.col(f"l{i}{k}") * F.col(f"z{k}") for k in range(i)), F.lit(0.0))) / F.col(f"l{i}{i}"))
        z.append(F.col(name) ** 2)
    return j.select(*kept, sum(z[1:], z[0]).alias("d2"), sum(z[2:], z[1]).alias("d2_given"))


def _quantile(rows: DataFrame, by: list[str], value: str, share: float, name: str) -> DataFrame:
    """Per group the value below which ``share`` of the rows lie: exact counts in 1/64-octave bins."""
    bins = (rows.select(*by, F.floor(F.log2(F.greatest(F.col(value), F.lit(1e-9))) * 64).alias("bin"))
            .groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("k")))
    up = W.partitionBy(*by).orderBy("bin")      # a few hundred bins per group
    ranked = bins.withColumn("upto", F.sum("k").over(up)).withColumn("all", F.sum("k").over(W.partitionBy(*by)))
    return stored(ranked.where(F.col("upto") >= share * F.col("all")).groupBy(*by)
                  .agg(F.pow(F.lit(2.0), (F.min("bin") + 1) / 64.0).alias(name)), "mcd-quantile")


def _mcd(rows: DataFrame) -> DataFrame:
    """Minimum-covariance-determinant estimate per group ``g``, with the scale of its distances.

    Both starts go through the concentration steps side by side, as ``s`` 0 and 1.
    """
    p, by = len(DIMS), ["g", "s"]
    twice = rows.withColumn("s", F.explode(F.array(F.lit(0), F.lit(1))))
    # start 0: the central share by scaled distance from the medians; start 1: all rows
    # (tables per group are stored before they are joined: their known size lets them be
    # broadcast, so that rows are never dealt out by group)
    mid = stored(rows.groupBy("g").agg(*[F.percentile_approx(f"x{i}", 0.5, 1000).alias(f"q{i}")
                                         for i in range(p)]), "mcd-median")
    near = _spread(twice, mid, ["g"]).withColumn("d2", sum(
        (F.pow(F.col(f"x{i}") - F.col(f"q{i}"), F.lit(2)) / FLOORS[i] for i in range(1, p)), F.lit(0.0)))
    cut = _quantile(near.where("s = 0"), ["g"], "d2", KEEP, "cut")
    est = stored(_moments(_spread(near, cut, ["g"]), by, (F.col("s") == 1) | (F.col("d2") <= F.col("cut"))), "mcd-estimate")
    for _ in range(STEPS):
        d = _distances(twice, est, by)
        cut = _quantile(d, by, "d2", KEEP, "cut")
        est = stored(_moments(_spread(d, cut, by), by, F.col("d2") <= F.col("cut")), "mcd-estimate")
    # the smaller determinant wins; a tie goes to the first start
    best = est.groupBy("g").agg(F.min(F.struct("det", "s")).alias("_b"))
    est = stored(est.join(best, "g").where("s = _b.s").drop("_b", "s"), "mcd-best")
    def scales(est: DataFrame) -> DataFrame:
        return (_quantile(_distances(rows, est, ["g"]), ["g"], "d2_given", 0.5, "mid")
                .withColumn("scale", F.greatest(F.lit(1.0), F.col("mid") / CHI_MEDIAN)).drop("mid"))
    # the judging estimate: all rows that the start does not call outliers
    near = _spread(_distances(rows, est, ["g"]), scales(est), ["g"])
    est = stored(_moments(near, ["g"], F.col("d2_given") <= CUTOFF * F.col("scale")), "mcd-judging")
    size = rows.groupBy("g").agg(F.count(F.lit(1)).alias("rows"))
    return stored(est.join(scales(est), "g").join(size, "g"), "mcd-group")


def _group(*parts: Column | str) -> Column:
    """Group key of a level: the level's values, each in its own place."""
    return F.to_json(F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"k{i}")
                                for i, c in enumerate(parts)]), {"ignoreNullFields": "false"})


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, base statistics, base_failed, distance, kept.

    Null texts have no words; they and all texts under 50 words, or with more than
    half of their words in repeated 3-word windows, fail the base rules. Null
    language or source is a value of its own. Repeated rows are judged alike and
    count as often as they occur. Texts that pass the base rules are kept unless
    their distance exceeds the cutoff. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("\0")).alias("lang"),
                       F.coalesce(F.col("source").cast("string"), F.lit("\0")).alias("source"),
                       base_statistics(text).alias("_s")).select("doc_id", "lang", "source", "_s.*")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = stored(rows.withColumn("base_failed", failed), "quality-rows")
    judged = rows.where("not base_failed").select("lang", "source", *[v.alias(f"x{i}") for i, v in enumerate(_vector())])
    # estimates per (language, source), per language and over all rows, in one pass
    levels = [_group("lang", "source"), _group("lang"), F.substring(F.concat(F.lit("all"), "lang"), 1, 3)]
    est = _mcd(stored(judged.select(F.explode(F.array(*levels)).alias("g"),
                                    *[f"x{i}" for i in range(len(DIMS))]), "quality-vectors"))
    values = [f"m{i}" for i in range(len(DIMS))] + [
        f"l{i}{j}" for i in range(len(DIMS)) for j in range(i + 1)] + ["scale", "rows"]
    groups = judged.select("lang", "source").distinct()
    for n, level in enumerate(levels):
        groups = groups.withColumn("g", level).join(est.select("g", F.struct(*values).alias(f"e{n}")), "g", "left").drop("g")
    pick = F.when(F.col("e0.rows") >= MIN_GROUP, F.col("e0")).when(
        F.col("e1.rows") >= MIN_GROUP, F.col("e1")).otherwise(F.col("e2"))
    groups = stored(groups.select("lang", "source", pick.alias("e")).select("lang", "source", "e.*"), "quality-groups")
    vectors = rows.where("not base_failed").withColumns({f"x{i}": v for i, v in enumerate(_vector())})
    out = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    scaled = (_distances(_spread(vectors, groups.select("lang", "source", "scale"), ["lang", "source"]),
                         groups, ["lang", "source"])
              .withColumn("distance", F.col("d2_given") / F.col("scale")))
    return (scaled.select(*out, "distance", (F.col("distance") <= CUTOFF).alias("kept"))
            .unionByName(rows.where("base_failed").select(
                *out, F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept"))))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass; same columns.

    Rows that share an id (or have none) pass if one of them does. Null and blank texts fail the
    base rules; an empty table stays empty.
    """
    good = quality_rules(docs).where("kept").select(F.col("doc_id").alias("_good")).distinct()
    return docs.join(good, F.col("doc_id").eqNullSafe(F.col("_good")), "left_semi")
