"""Mixing domains to target weights by soft membership. DataFrame functions only.

A naive Bayes classifier gives each document's posterior of every domain. Its features are strings of
one to three letters, picked by what they tell of the domains of the labelled rows, whatever their script.
Document rates r >= least are then fitted so that
the expected tokens of each domain, the sum of r * tokens * posterior, come to the targets: projected
gradient steps on the squared residuals, scaled by their curvature, each of them one aggregation of a
few sums over the documents. A rate is a function of the document's posteriors and of the steps' few numbers, so no
rates are stored between steps.
"""

from __future__ import annotations

import warnings
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, stored

#: Domains at most: the model is one number for each of them and each feature, and the fit's curvature one for each two.
DOMAINS = 256
#: Part of all strings up to which one is picked first: counting commoner ones costs more, so they come where a domain has no others left.
COMMON = 0.01


def _plus(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def _counts(text: Column, features: list[str]) -> list[Column]:
    """How often each feature occurs in a lower-cased text."""
    return [((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(f), F.lit("")))) / len(f.encode())).cast("double") for f in features]


def learned_features(labelled: DataFrame, each: int = 7, longest: int = 3) -> list[str]:
    """Strings of letters that tell domains apart, from columns text and domain, all rows of which count.

    A string's worth for a domain is its share there times the log of that share over the mean share
    of the domains, so what is common and peculiar comes first. Every domain picks `each` strings of its own (fewer, if it hasn't so
    many), whatever the number of domains; a string that is part of one that the domain has, or holds one, is left out, and one
    that another domain has picked counts for both. The best few of every domain are all that reaches the driver.
    """
    words = labelled.select(F.col("domain").cast("string").alias("domain"), F.explode(F.split(F.lower(F.col("text").cast("string")), r"[^\p{L}\p{M}]+")).alias("word")).where("word <> ''")
    words = words.groupBy("domain", "word").agg(F.count("*").alias("n")).withColumn("letters", F.split("word", ""))
    of_size = lambda k: F.when(F.size("letters") >= k, F.transform(F.sequence(F.lit(0), F.size("letters") - k), lambda i: F.array_join(F.slice("letters", i + 1, k), "")))
    strings = F.explode(F.flatten(F.array_compact(F.array(*[of_size(k) for k in range(1, longest + 1)]))))
    grams = stored(words.select("domain", "n", strings.alias("gram")).groupBy("domain", "gram").agg(F.sum("n").alias("n")), "grams")
    totals = {r["domain"]: r["n"] for r in grams.groupBy("domain").agg(F.sum("n").alias("n")).orderBy("domain").limit(DOMAINS + 1).collect()}
    if not totals:
        return []
    share = [F.coalesce(F.sum(F.when(F.col("domain") == d, F.col("n"))), F.lit(0)) / n for d, n in totals.items()]
    shares = grams.groupBy("gram").agg(F.array(*share).alias("shares")).withColumn("mean", F.aggregate("shares", F.lit(0.0), lambda a, x: a + x) / len(totals))
    worth = shares.select("gram", "mean", F.posexplode("shares").alias("domain", "share")).where(F.col("share") > F.col("mean")).withColumn("worth", F.col("share") * F.log(F.col("share") / F.col("mean")))
    rank = F.row_number().over(Window.partitionBy("domain").orderBy(F.col("mean") >= COMMON, F.desc("worth"), "gram"))
    best = worth.withColumn("rank", rank).where(F.col("rank") <= 16 * each).orderBy("rank", "domain").select("domain", "gram").collect()
    chosen: dict[int, list[str]] = {}
    for r in best:
        own = chosen.setdefault(r["domain"], [])
        if len(own) < each and not any(r["gram"] in x or x in r["gram"] for x in own):
            own.append(r["gram"])
    return sorted({g for own in chosen.values() for g in own})


def posteriors(docs: DataFrame, labelled: DataFrame, evidence: float = 100.0, each: int = 7) -> tuple[DataFrame, list[str]]:
    """docs with tokens (words of the text) and p, an array of posteriors by domain, and the domains, sorted.

    labelled: text and domain; rows without either don't count; they are written once and read thrice. The model, one number a domain and
    feature, and what it is picked from (learned_features) are all that reaches the driver. evidence: occurrences of
    features that a text counts for at most, so that a long text of several domains isn't all of one. each: features picked for
    each domain; a text is searched once for each feature, so the work grows with the domains.
    A text without any feature has the priors. More than DOMAINS domains are an error.
    """
    taken = [*docs.columns, "tokens", "p"]
    rows = stored(labelled.where("text is not null and domain is not null").select("text", F.col("domain").cast("string").alias("domain")), "labelled")
    priors = rows.groupBy("domain").agg(F.count("*").alias("n")).orderBy("domain").limit(DOMAINS + 1).collect()
    if len(priors) > DOMAINS:
        raise ValueError(f"more than {DOMAINS} domains among the labelled rows")
    if not priors:
        return docs.withColumn("tokens", F.lit(0).cast("long")).withColumn("p", F.expr("cast(array() as array<double>)")), []
    features, domains = learned_features(rows, each), [r["domain"] for r in priors]
    low, seen, weigh, ll, e, model = (free_name(x, taken) for x in ("low", "seen", "weigh", "ll", "e", "model"))
    found = F.filter(F.array(*[F.struct(F.lit(i).alias("at"), c.alias("n")) for i, c in enumerate(_counts(F.col(low), features))]), lambda x: x["n"] > 0)
    none = F.expr("cast(array() as array<struct<at: int, n: double>>)")
    counted = lambda t: t.withColumn(low, F.lower(F.coalesce(F.col("text").cast("string"), F.lit("")))).withColumn(seen, found if features else none)
    logs = np.full((len(domains), len(features)), 0.5)
    for r in counted(rows).select("domain", F.explode(seen).alias("x")).groupBy("domain", "x.at").agg(F.sum("x.n").alias("n")).collect():  # a number a domain and feature at most
        logs[domains.index(r["domain"]), r["at"]] += r["n"]
    logs = np.log(logs / logs.sum(axis=1, keepdims=True)) if features else logs
    total = sum(r["n"] for r in priors)
    of_domain = [(float(np.log(r["n"] / total)), own.tolist()) for r, own in zip(priors, logs)]
    # One row of DOMAINS * features numbers at most, so that plans don't grow with them.
    one = docs.sparkSession.createDataFrame([(of_domain,)], f"`{model}` array<struct<prior: double, logs: array<double>>>")
    sum_of = lambda xs, f: F.aggregate(xs, F.lit(0.0), lambda a, x: a + f(x))
    scored = counted(docs).crossJoin(F.broadcast(one)).withColumn(weigh, F.lit(evidence) / F.greatest(F.lit(evidence), sum_of(seen, lambda x: x["n"])))
    scored = scored.withColumn(ll, F.transform(model, lambda d: d["prior"] + F.col(weigh) * sum_of(seen, lambda x: x["n"] * F.get(d["logs"], x["at"]))))
    scored = scored.withColumn(e, F.transform(ll, lambda x: F.exp(x - F.array_max(ll))))
    scored = scored.withColumn("p", F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b)))
    tokens = F.regexp_count(low, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    return scored.withColumn("tokens", tokens).drop(low, seen, weigh, ll, e, model), domains


Step = tuple[list[float], list[float]]


def _dot(v: list[float]) -> Column:
    return _plus([F.lit(0.0)] + [F.lit(float(x)) * F.get("p", F.lit(i)) for i, x in enumerate(v)])


def _held(residual: list[float], least: float) -> Column:
    """Rates on the bound that the residuals would push beyond it."""
    return (F.col("rate") <= least + 1e-6) & (_dot(residual) <= 0)


def _after(step: Step, least: float) -> Column:
    """Rates after a step along (move, residual): those that aren't held go on by their posteriors' share of move, projected onto [least, inf)."""
    move, residual = step
    return F.when(_held(residual, least), F.col("rate")).otherwise(F.greatest(F.lit(least), F.col("rate") + _dot(move)))


def rated(members: DataFrame, steps: list[Step], least: float) -> DataFrame:
    """members with rate, a function of p and of the steps: 1, or least where that is more, then one step after another."""
    out = members.withColumn("rate", F.lit(max(1.0, least)))
    for step in steps:
        out = out.withColumn("rate", _after(step, least))
    return out


def fit_rates(members: DataFrame, targets: list[float], least: float = 0.0, rounds: int = 30, tolerance: float = 1e-4) -> list[Step]:
    """The steps of projected gradient descent; members: tokens and p.

    Half the squared residuals (targets less expected tokens by domain) is minimised in the metric of
    tokens: a step moves a document's rate by its posteriors times a vector of one number a domain,
    then projects. That vector is the residuals, scaled by the inverse of their curvature over the
    rates that aren't held at the bound, so domains of any size converge alike. A round is one aggregation of
    k * k sums for the curvature, and one of k sums for each of a few lengths and dampings, of which the best is
    taken. Ends once all residuals are within tolerance of the targets, or nothing gets better,
    or after `rounds`; warns of residuals of more than 1 % of a target, as where a target can't be met.
    """
    k = range(len(targets))
    p = lambda i: F.get("p", F.lit(i))
    aim, scale = np.array(targets, float), np.maximum(np.array(targets, float), 1.0)
    sums = lambda rate: [F.coalesce(F.sum(rate * F.col("tokens") * p(i)), F.lit(0.0)) for i in k]
    steps: list[Step] = []
    residual = aim - np.array(rated(members, [], least).agg(*sums(F.col("rate"))).first(), float)
    for _ in range(rounds):
        if np.max(np.abs(residual) / scale, initial=0.0) <= tolerance:
            break
        now, own = rated(members, steps, least), residual.tolist()
        free = ~_held(own, least)
        row = now.agg(*[F.coalesce(F.sum(F.when(free, F.col("tokens") * p(i) * p(j))), F.lit(0.0)) for i in k for j in k]).first()
        curvature = np.array(row, float).reshape(len(targets), -1)
        damped = [curvature + np.eye(len(targets)) * (x * np.trace(curvature) + 1e-12) for x in (1e-9, 1e-4, 1e-2)]
        tried = [((length * np.linalg.solve(c, residual)).tolist(), own) for c in damped for length in (1.0, 0.3, 0.1, 0.03)]
        met = np.array(now.agg(*[x for step in tried for x in sums(_after(step, least))]).first(), float).reshape(len(tried), -1)
        cost = ((aim - met) ** 2).sum(1)
        best = int(cost.argmin())
        if cost[best] >= (residual**2).sum() * (1 - 1e-7):
            break
        steps.append(tried[best])
        residual = aim - met[best]
    if (worst := float(np.max(np.abs(residual) / scale, initial=0.0))) > 0.01:
        warnings.warn(f"mixing: a residual of {worst:.3f} of its target stays", stacklevel=2)
    return steps


def mixed(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], least: float = 0.0, budget: float | None = None, rounds: int = 30) -> DataFrame:
    """docs with domain (the likeliest), tokens, p, rate and copies. More than DOMAINS domains among the labelled rows are an error.

    docs: doc_id and text, and any other columns, which are kept unless they clash with the new ones; those
    are replaced. labelled: text and domain. weights: share of the tokens by domain (others: 0),
    scaled to 1. budget: expected tokens altogether; by default the fewest at which no domain has to
    lose any. rate >= least is the expected number of copies; copies is rate rounded up or down by
    a hash of doc_id and text, so that it's right in expectation and the same in every run.

    Null and empty texts have no tokens: they weigh nothing and get the rate that the priors give. Texts of any
    length count whole.
    Repeated rows get equal copies; a null doc_id is no obstacle; without labelled rows every rate is
    1; empty tables give no rows.
    """
    plain = docs.drop("domain", "tokens", "p", "rate", "copies")
    with_p, domains = posteriors(plain, labelled)
    if not domains:
        return with_p.withColumn("domain", F.lit(None).cast("string")).withColumn("rate", F.lit(1.0)).withColumn("copies", F.lit(1))
    with_p = stored(with_p, "members")  # the rounds read two columns of it
    members = with_p.select("tokens", "p")
    now = members.agg(*[F.coalesce(F.sum(F.col("tokens") * F.get("p", F.lit(i))), F.lit(0.0)) for i in range(len(domains))]).first()
    share = [max(0.0, weights.get(d, 0.0)) for d in domains]
    share = [s / (sum(share) or 1.0) for s in share]
    whole = budget if budget is not None else max([now[i] / s for i, s in enumerate(share) if s > 0], default=0.0)
    steps = fit_rates(members, [s * whole for s in share], least, rounds)
    u = F.pmod(F.xxhash64(F.lit("copies"), "doc_id", F.col("text").cast("string")), F.lit(1 << 30)) / float(1 << 30)
    best = F.element_at(F.array(*map(F.lit, domains)), F.array_position("p", F.array_max("p")).cast("int"))
    return rated(with_p, steps, least).withColumn("domain", best).withColumn("copies", F.floor(F.col("rate") + u).cast("int"))
