"""Soft-membership mixing of domains to target weights.

1. A classifier learned from the labelled table gives every document its
   posterior over the domains (``high`` and ``low`` quality, ``toxic``): naive
   Bayes over hashed words, word beginnings and word endings.
2. Distributed projected-gradient least squares finds document rates. With
   a(d,k) = tokens(d) * posterior(d,k), the expected tokens of domain k are
   sum over d of rate(d) * a(d,k); the squared misfit to the targets falls along
   ``rate(d) -= posterior(d) . step`` and each rate is then clipped to its range.
   The step is the misfit times the inverse of the domains' own (domains x
   domains) matrix: in that metric the gradient's Lipschitz constant is 1, so the
   misfit falls in every round, and rates stay as even as the targets allow.

Only DataFrame operations run on the rows. The driver sees per-domain sums and
the fixed-size table of word weights.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import let, stored

DOMAINS = ("high", "low", "toxic")
#: Target share of the expected tokens per domain.
TARGETS = {"high": 0.85, "low": 0.12, "toxic": 0.03}
BUCKETS = 8192
#: Bound of the labelled sample that the classifier is fitted on (per domain).
SAMPLE_ROWS = 4000
PRIOR_COUNT = 8192.0    # weight of the overall slot frequencies in each domain's
TEMPER = 0.5            # words are not independent: their evidence is scaled down
#: Relative misfit at which the targets are met exactly, gain below which a step is the last, and
#: misfit up to which the result says that they are met.
TOLERANCE, LEAST_GAIN, MET = 1e-6, 0.05, 1e-3
STORE_EVERY = 6
WORDS = r"[\x20\x09-\x0D]+"


def domain_of(quality: Column, toxic: Column) -> Column:
    return F.when(toxic == 1, "toxic").when(quality == 1, "high").when(quality == 0, "low")


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), WORDS), lambda w: w != "")


def _slots(words: Column) -> Column:
    """Hash slots of the distinct words, their beginnings and their endings."""
    return let(F.array_distinct(words), lambda ws: F.transform(
        F.array_distinct(F.concat(
            ws, F.transform(ws, lambda w: F.concat(F.lit("^"), F.substring(w, 1, 4))),
            F.transform(ws, lambda w: F.concat(F.lit("$"), F.substring(w, -2, 2))))),
        lambda x: F.pmod(F.xxhash64(x), F.lit(BUCKETS)).cast("int")))


def fit_domains(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> dict:
    """Per domain: log prior and log weight of each slot.

    Fitted on at most ``sample_rows`` labelled documents per domain (those of
    smallest id hash); priors come from all labels.
    """
    lab = (labels.select(F.col("doc_id").cast("long").alias("_id"),
                         domain_of(F.col("quality"), F.col("toxic")).alias("_d"))
           .where("_id is not null and _d is not null").groupBy("_id").agg(F.max("_d").alias("_d")))
    share = {r["_d"]: r["n"] for r in lab.groupBy("_d").agg(F.count(F.lit(1)).alias("n")).collect()}
    sample = None
    for d in DOMAINS:
        part = lab.where(F.col("_d") == d).orderBy(F.xxhash64("_id"), "_id").limit(sample_rows)
        sample = part if sample is None else sample.unionByName(part)
    seen = stored(docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("_t"))
                  .join(F.broadcast(sample), "_id")          # bounded by sample_rows per domain
                  .select("_d", F.array_distinct(_slots(_words(F.col("_t")))).alias("_s")), "mixing-sample")
    counts = (seen.select("_d", F.explode("_s").alias("slot")).groupBy("slot", "_d")
              .agg(F.count(F.lit(1)).alias("n")).collect())         # at most BUCKETS rows per domain
    total = sum(share.values())
    in_domain, in_slot = dict.fromkeys(DOMAINS, 0), [0] * BUCKETS
    for r in counts:
        in_domain[r["_d"]] += r["n"]
        in_slot[r["slot"]] += r["n"]
    everywhere = sum(in_slot)
    model = {d: (math.log(share[d] / total), [0.0] * BUCKETS) for d in DOMAINS if in_domain[d]}
    for d, (_, w) in model.items():         # a slot never seen says nothing
        for x in range(BUCKETS):
            if in_slot[x]:
                w[x] = math.log(PRIOR_COUNT / (in_domain[d] + PRIOR_COUNT))
    for r in counts:
        q = in_slot[r["slot"]] / everywhere
        model[r["_d"]][1][r["slot"]] = math.log(
            (r["n"] + PRIOR_COUNT * q) / (q * (in_domain[r["_d"]] + PRIOR_COUNT)))
    if model:       # only differences between domains matter
        for s in range(BUCKETS):
            mid = sum(w[s] for _, w in model.values()) / len(model)
            for _, w in model.values():
                w[s] -= mid
    return model


def posteriors(docs: DataFrame, model: dict) -> DataFrame:
    """The input's columns with _tokens and one posterior _p_<domain> per domain.

    Domains without a labelled document have posterior 0; without any labels
    every domain is equally likely.
    """
    names = list(model)
    if not names:
        out = docs.withColumn("_tokens", F.size(_words(F.col("text").cast("string"))).cast("long"))
        return out.withColumns({f"_p_{d}": F.lit(1.0 / len(DOMAINS)) for d in DOMAINS})
    # constants of fixed size, folded into the plan once
    weights = [F.split(F.lit(",".join(f"{x:.3f}" for x in model[d][1])), ",").cast("array<double>")
               for d in names]
    zero = F.struct(*[F.lit(0.0).alias(d) for d in names])

    def add(acc: Column, slot: Column) -> Column:
        return F.struct(*[(acc[d] + F.get(w, slot)).alias(d) for d, w in zip(names, weights)])

    def scored(ws: Column) -> Column:
        return F.struct(F.size(ws).cast("long").alias("n"),
                        F.aggregate(_slots(ws), zero, add).alias("e"))

    out = docs.withColumn("_m", let(_words(F.col("text").cast("string")), scored))
    logit = {d: F.col(f"_m.e.{d}") * TEMPER + model[d][0] for d in names}
    top = F.greatest(*logit.values()) if len(names) > 1 else logit[names[0]]
    out = out.withColumns({"_tokens": F.col("_m.n"), **{f"_x_{d}": F.exp(logit[d] - top) for d in names}})
    total = sum((F.col(f"_x_{d}") for d in names), F.lit(0.0))
    return (out.withColumns({f"_p_{d}": (F.col(f"_x_{d}") / total) if d in names else F.lit(0.0) for d in DOMAINS})
            .drop("_m", *[f"_x_{d}" for d in names]))


def _solve(matrix: list[list[float]], right: list[float]) -> list[float]:
    """Gauss elimination of a small symmetric system, with a small ridge for domains that
    have no mass or cannot be told apart."""
    n = len(right)
    ridge = 1e-9 * max((matrix[i][i] for i in range(n)), default=0.0) or 1.0
    m = [[x + ridge * (i == j) for j, x in enumerate(row)] + [b] for i, (row, b) in enumerate(zip(matrix, right))]
    for i in range(n):
        for k in range(n):
            if k != i:
                f = m[k][i] / m[i][i]
                m[k] = [x - f * y for x, y in zip(m[k], m[i])]
    return [m[i][n] / m[i][i] for i in range(n)]


def fit_rates(rows: DataFrame, targets: dict, budget: float, max_rate: float | None) -> tuple[DataFrame, dict]:
    """(rows with _rate, report) by projected-gradient least squares.

    ``rows`` has _tokens and _p_<domain>. The token total is ``budget`` times the
    corpus's. Domains without expected tokens are left out of the targets; a target
    out of reach of ``max_rate`` is approached in the least-squares sense. Steps go on until
    the targets are met or no step lowers the misfit (the norm of what is missing over the
    token total) by a thousandth; the report has it as it is at the returned rates.
    """
    a = {d: F.col("_tokens") * F.col(f"_p_{d}") for d in DOMAINS}
    sums = [F.coalesce(F.sum("_tokens"), F.lit(0)).alias("tokens")]
    sums += [F.coalesce(F.sum(a[d]), F.lit(0.0)).alias(f"m_{d}") for d in DOMAINS]
    sums += [F.coalesce(F.sum(a[d] * F.col(f"_p_{e}")), F.lit(0.0)).alias(f"g_{d}_{e}")
             for d in DOMAINS for e in DOMAINS]
    s = rows.agg(*sums).first()
    live = [d for d in DOMAINS if s[f"m_{d}"] > 1e-9 * max(1, s["tokens"]) and targets.get(d, 0) > 0]
    wanted = sum(targets[d] for d in live)
    if not live or not wanted:
        return rows.withColumn("_rate", F.lit(1.0)), {"rounds": 0, "misfit": 0.0}
    goal = {d: targets[d] / wanted if d in live else 0.0 for d in DOMAINS}
    total = s["tokens"] * budget
    goal = {d: goal[d] * total for d in DOMAINS}
    def clipped(rate: Column) -> Column:
        rate = F.greatest(F.lit(0.0), rate)
        return rate if max_rate is None else F.least(F.lit(float(max_rate)), rate)

    base = rows.withColumn("_rate", clipped(F.lit(total / max(1, s["tokens"]))))
    steepest = sum(s[f"g_{d}_{d}"] for d in DOMAINS)        # at least the largest eigenvalue

    def measured(rate: Column) -> tuple[float, list[float], list[list[float]]]:
        """Misfit, what is missing, and the products of the domains over the rows off the bounds."""
        free = (rate > 0) if max_rate is None else (rate > 0) & (rate < float(max_rate))
        got = base.withColumn("_r", rate).withColumn("_free", free.cast("double")).agg(
            *[F.coalesce(F.sum(a[d] * F.col("_r")), F.lit(0.0)).alias(d) for d in DOMAINS],
            *[F.coalesce(F.sum(a[d] * F.col(f"_p_{e}") * F.col("_free")), F.lit(0.0)).alias(f"g_{d}_{e}")
              for d in DOMAINS for e in DOMAINS]).first()
        left = [got[d] - goal[d] for d in DOMAINS]
        gram = [[got[f"g_{d}_{e}"] for e in DOMAINS] for d in DOMAINS]
        return math.sqrt(sum(x * x for x in left)) / total, left, gram

    rate, rounds = F.col("_rate"), 0
    misfit, left, gram = measured(rate)
    while misfit >= TOLERANCE:
        # the step scaled by the rows that can move; where clipping spoils it, the plain gradient's,
        # which never goes up
        for step in (_solve(gram, left), [x / steepest for x in left]):
            tried = clipped(rate - sum((F.col(f"_p_{d}") * F.lit(x) for d, x in zip(DOMAINS, step)), F.lit(0.0)))
            new = measured(tried)
            if new[0] < (1 - LEAST_GAIN) * misfit:
                break
        else:
            break
        rate, rounds = tried, rounds + 1
        misfit, left, gram = new
        if rounds % STORE_EVERY == 0:       # keeps the expression short
            base, rate = stored(base.withColumn("_rate", rate), "mixing-rates"), F.col("_rate")
    return base.withColumn("_rate", rate), {"rounds": rounds, "misfit": misfit, "goal": goal}


def _copies(rate: Column) -> Column:
    """Whole copies whose mean is the rate, by a hash of the id (same in every run)."""
    u = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit("mixing")), F.lit(1 << 30)) / float(1 << 30)
    return F.floor(rate + u).cast("long")


def soft_mixing(docs: DataFrame, labels: DataFrame, targets: dict | None = None,
                budget: float = 1.0, max_rate: float | None = None,
                sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: doc_id, n_tokens, posteriors, likeliest domain, rate, copies.

    Every row also carries the relative ``misfit`` of the fitted rates and whether the targets
    are met (``targets_met``: a misfit of at most a thousandth).
    Null and empty texts have 0 tokens and the prior as posterior; repeated rows get
    equal rates; ties of posteriors go to the first domain named; an empty table
    gives no rows; without labels all domains are equally likely.
    """
    model = fit_domains(docs, labels, sample_rows)
    rows = stored(posteriors(docs.select("doc_id", "text"), model)
                  .select(F.col("doc_id").cast("long").alias("doc_id"), "_tokens",
                          *[f"_p_{d}" for d in DOMAINS]), "mixing-posteriors")
    rated, report = fit_rates(rows, targets or TARGETS, budget, max_rate)
    best = F.greatest(*[F.col(f"_p_{d}") for d in DOMAINS])
    domain = F.coalesce(*[F.when(F.col(f"_p_{d}") == best, d) for d in DOMAINS])
    return rated.select("doc_id", F.col("_tokens").alias("n_tokens"),
                        *[F.col(f"_p_{d}").alias(f"p_{d}") for d in DOMAINS],
                        domain.alias("domain"), F.col("_rate").alias("rate"),
                        _copies(F.col("_rate")).alias("copies"), F.lit(report["misfit"]).alias("misfit"),
                        F.lit(report["misfit"] <= MET).alias("targets_met"))


def thin_to_targets(docs: DataFrame, labels: DataFrame, targets: dict | None = None,
                    budget: float = 0.95) -> DataFrame:
    """The documents drawn at rates of at most 1 for ``budget`` of the tokens; same columns.

    Null and empty texts are drawn like others, at the prior's rate. Rows that share an id are
    drawn together and go if one of them is not drawn; rows with a null id always stay; an empty
    table stays empty. Targets out of reach at a rate of 1 are approached.
    """
    mixed = soft_mixing(docs, labels, targets, budget=budget, max_rate=1.0)
    out = mixed.where("copies < 1").select("doc_id").distinct()
    return docs.join(out, "doc_id", "left_anti")
