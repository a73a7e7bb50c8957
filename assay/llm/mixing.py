"""Operator 7 [native]: rates of documents that mix soft domains to target weights.

A classifier fitted to a labelled table gives each document a posterior over domains. Rates
r >= 0 of the documents are then fitted by least squares, so that the expected token totals of
the domains, sum of r * tokens * posterior, meet the targets:

    minimise 1/2 * |sum_d (n_d / N) r_d p_d - t|^2  over  r >= 0,  from r = 1.

The solver is projected gradient descent. In the inner product weighted by the documents' shares
of tokens the gradient of r_d is p_d . e, e being the K residuals; it is scaled by the K x K
curvature of the documents that are not at 0, so a few iterations do. Each iteration is one
aggregate over the documents that yields the residuals and the curvature. A document's rate is
a fold of its own posterior over the steps so far, so the iterations write nothing back, join
nothing, and recover from lost executors as any aggregate.

DataFrame functions only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.llm.common import clear_name, staged

# Labelled rows the classifier is fitted to at most.
SAMPLE_ROWS = 6_000
MIN_SUPPORT = 8
# Likelihood ratio (chi-square, one degree) that chance reaches once in a thousand features.
DIFFERENCE = 10.83
# Times its share of all rows that a word's share of a domain must be to speak for it. Words a
# domain merely has fewer of come in their hundreds in any text, and would drown all others.
LIFT = 1.5
SMOOTHING = 8.0
ITERATIONS = 40
# Largest residual, as a share of all tokens, at which iterations end.
TOLERANCE = 1e-4

DOMAINS = ("high", "toxic", "low")
TARGETS = {"high": 0.90, "toxic": 0.02, "low": 0.08}


def label_domain(quality: Column, toxic: Column) -> Column:
    """Domain of a labelled row: toxic before low quality before high."""
    return F.when(toxic == 1, F.lit("toxic")).when(quality == 0, F.lit("low")).otherwise(F.lit("high"))


def token_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def document_features(text: Column) -> Column:
    """Features of a text, words repeated as they come: its words, of letters of any script, and
    levels of its style, which begin with ``=`` and so are no words.
    """
    whole = F.coalesce(text, F.lit(""))
    size = F.greatest(F.length(whole), F.lit(1)).cast("double")

    def level(name: str, amount: Column) -> Column:
        # Doubling steps of a share, from 1/4096 up.
        step = F.floor(F.log2(F.greatest(amount / size, F.lit(1 / 8192)))).cast("string")
        return F.concat(F.lit(f"={name}"), step)

    words = F.split(F.lower(whole), r"[^\p{L}\p{M}]+")
    return F.concat(
        words,
        F.array(
            level("symbols", F.regexp_count(whole, F.lit("[#*$%&|<>]"))),
            level("marks", F.regexp_count(whole, F.lit("[!?]"))),
            level("capitals", F.regexp_count(whole, F.lit("[A-Z]+"))),
            level("words", F.size(words)),
        ),
    )


@dataclass(frozen=True)
class DomainModel:
    domains: tuple[str, ...]
    prior: tuple[float, ...]
    weights: dict[str, tuple[float, ...]]  # of each feature kept, its log share by domain

    def posterior(self, features: Column) -> Column:
        """Posterior over the domains, an array in their order."""
        start = F.array(*[F.lit(float(p)) for p in self.prior])
        score = start
        if self.weights:
            known = F.array(*[F.lit(f) for f in self.weights])
            table = F.map_from_arrays(
                known, F.array(*[F.array(*[F.lit(float(x)) for x in w]) for w in self.weights.values()])
            )
            score = F.aggregate(
                F.array_intersect(features, known),
                start,
                lambda held, f: F.zip_with(held, F.element_at(table, f), lambda a, b: a + b),
            )
        return score


def softmax(scores: Column) -> Column:
    raised = F.transform(scores, lambda s: F.exp(s - F.array_max(scores)))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda a, b: a + b))


def fit_domains(
    documents: DataFrame,
    labelled: DataFrame,
    *,
    domains: Sequence[str] = DOMAINS,
    key: str = "doc_id",
    text: str = "text",
    domain: str = "domain",
    sample_rows: int = SAMPLE_ROWS,
) -> DomainModel:
    """Naive Bayes over all features that tell a domain from the others, from a bounded sample.

    A word is kept for any one domain that it speaks for, a level of style for any difference,
    so a large domain or language crowds out no other.

    ``labelled`` is (key, domain). The sample is drawn from it by the hash of its ids; its ids
    are what is broadcast. Labels of one id that disagree count as the first in the order of
    ``domains`` reversed; null or unknown ones are left out. With no labelled row every
    posterior is uniform.
    """
    rank = F.coalesce(*[F.when(F.col(domain) == d, F.lit(i)) for i, d in enumerate(domains)])
    chosen = (
        labelled.select(F.col(key).alias("k_"), rank.alias("d_"))
        .dropna()
        .groupBy("k_")
        .agg(F.max("d_").alias("d_"))
        .orderBy(F.xxhash64("k_"), "k_")
        .limit(sample_rows)
    )
    # At most sample_rows pairs of numbers: a bounded broadcast.
    sample = documents.select(F.col(key).alias("k_"), F.col(text).alias("t_")).join(
        F.broadcast(chosen), "k_"
    )
    sample = staged(sample.select("d_", F.array_distinct(document_features(F.col("t_"))).alias("f_")), "domains")
    kinds = range(len(domains))
    counts = [F.count(F.when(F.col("d_") == i, 1)).alias(f"n{i}") for i in kinds]
    total = sample.agg(*counts).first()
    sizes = [total[f"n{i}"] for i in kinds]
    n = sum(sizes)
    if not n:
        return DomainModel(tuple(domains), (0.0,) * len(domains), {})
    overall = (F.col("all") + 0.5) / F.lit(float(n + 1))
    # Shares are drawn towards the overall one, so a rare feature tells little.
    shares = [
        (F.col(f"n{i}") + SMOOTHING * overall) / F.lit(float(sizes[i] + SMOOTHING)) for i in kinds
    ]
    logs = [F.log(share / overall) for share in shares]

    def differs(i: int) -> Column:
        """Likelihood ratio of the feature and the domain against their being independent."""
        inside, every, size = F.col(f"n{i}"), F.col("all"), F.lit(float(sizes[i]))
        cells = (
            (inside, every * size),
            (every - inside, every * (n - size)),
            (size - inside, size * (n - every)),
            (n - size - every + inside, (n - size) * (n - every)),
        )
        ratio = F.lit(0.0)
        for found, expected in cells:
            ratio = ratio + F.when(found > 0, 2 * found * F.log(found * n / expected)).otherwise(0.0)
        return ratio > DIFFERENCE

    speaks = F.lit(False)
    for i in kinds:
        speaks = speaks | (differs(i) & (F.col("f_").startswith("=") | (logs[i] > math.log(LIFT))))
    rows = (
        sample.select("d_", F.explode("f_").alias("f_"))
        .groupBy("f_")
        .agg(F.count("*").alias("all"), *counts)
        .where((F.col("all") >= MIN_SUPPORT) & (F.col("f_") != "") & speaks)
        .select("f_", *[x.alias(f"w{i}") for i, x in enumerate(logs)])
        .orderBy("f_")
        .collect()
    )
    prior = tuple(math.log((s + 0.5) / (n + 0.5 * len(sizes))) for s in sizes)
    weights = {r["f_"]: tuple(r[f"w{i}"] for i in kinds) for r in rows}
    return DomainModel(tuple(domains), prior, weights)


def rate_of(posterior: Column, steps: Sequence[tuple[float, ...]]) -> Column:
    """A document's rate after ``steps``: each lowers it by posterior . step, to 0 at least."""
    if not steps:
        return F.lit(1.0)
    history = F.array(*[F.array(*[F.lit(float(x)) for x in step]) for step in steps])

    def lower(rate: Column, step: Column) -> Column:
        slope = F.lit(0.0)
        for k in range(len(steps[0])):
            slope = slope + posterior[k] * step[k]
        return F.greatest(F.lit(0.0), rate - slope)

    return F.aggregate(history, F.lit(1.0), lower)


def fit_rates(
    soft: DataFrame,
    targets: Sequence[float],
    *,
    iterations: int = ITERATIONS,
    tolerance: float = TOLERANCE,
) -> list[tuple[float, ...]]:
    """Steps for ``rate_of``. ``soft`` has ``tokens`` and ``posterior``; targets are shares."""
    size = len(targets)
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    mass = soft.agg(F.sum("tokens").alias("n")).first()["n"] or 0
    posterior = [F.col("posterior")[k] for k in range(size)]
    accepted: list[tuple[float, ...]] = []
    trials: list[np.ndarray] = []  # steps to try from here, the boldest last
    least = math.inf
    widest = 1.0
    for _ in range(iterations if mass else 0):
        steps = [*accepted, tuple(map(float, trials.pop()))] if trials else accepted
        share = F.col("tokens") / F.lit(float(mass))
        rated = soft.withColumn("rate", rate_of(F.col("posterior"), steps))
        inside = F.when(F.col("rate") > 0, share).otherwise(F.lit(0.0))
        sums = rated.agg(
            *[F.sum(share * F.col("rate") * posterior[k]).alias(f"s{k}") for k in range(size)],
            *[F.sum(inside * posterior[i] * posterior[j]).alias(f"h{i}_{j}") for i, j in pairs],
        ).first()
        residuals = np.array([sums[f"s{k}"] - targets[k] for k in range(size)])
        loss = float(residuals @ residuals)
        if loss < least:
            gain, least, accepted = least - loss, loss, steps
            if np.abs(residuals).max() < tolerance or gain < 1e-4 * tolerance**2:
                break
            metric = np.zeros((size, size))
            for i, j in pairs:
                metric[i, j] = metric[j, i] = sums[f"h{i}_{j}"]
            if not accepted:  # nobody is at 0 yet: this bounds every later curvature
                widest = float(np.linalg.eigvalsh(metric)[-1])
            scaled = np.linalg.solve(metric + 1e-6 * np.eye(size), residuals)
            # The plain step always gains; the scaled one gains more where few rates reach 0.
            trials = [residuals / widest, scaled / 4, scaled]
        elif not trials:
            break
    return accepted


def mix_sources(
    documents: DataFrame,
    labelled: DataFrame,
    *,
    targets: dict[str, float] = TARGETS,
    key: str = "doc_id",
    text: str = "text",
    keep: Sequence[str] | None = None,
    name: str = "mixing",
) -> DataFrame:
    """``documents``, or its columns ``keep``, and a struct column ``name``: tokens, posterior by domain, rate.

    ``targets`` are the wanted token totals of the domains as shares of all tokens. A domain
    that no document belongs to stays short of its target. A null or empty text has no tokens;
    its rate follows from the posterior as that of any other. Rows are independent once the
    model and the residuals are known, so repeated rows and ids count as often as they occur.
    With no rows or no tokens the rates are 1.
    """
    if name.lower() in {c.lower() for c in documents.columns}:
        raise ValueError(f"documents already have a column {name}")
    domains = tuple(targets)
    model = fit_domains(documents, labelled, domains=domains, key=key, text=text)
    columns = documents.columns if keep is None else list(keep)
    tokens, scores, posterior = (
        clear_name(documents, n) for n in ("mixing_tokens", "mixing_scores", "mixing_posterior")
    )
    # Texts are gone through once: what the iterations and the result need is written.
    soft = staged(
        documents.withColumn(tokens, token_count(F.col(text)))
        .withColumn(scores, model.posterior(document_features(F.col(text))))
        .withColumn(posterior, softmax(F.col(scores)))
        .select(*columns, tokens, posterior),
        "mixing",
    )
    fitted = soft.select(F.col(tokens).alias("tokens"), F.col(posterior).alias("posterior"))
    steps = fit_rates(fitted, [targets[d] for d in domains])
    return soft.select(
        *columns,
        F.struct(
            F.col(tokens).alias("tokens"),
            F.struct(*[F.col(posterior)[i].alias(d) for i, d in enumerate(domains)]).alias("posterior"),
            rate_of(F.col(posterior), steps).alias("rate"),
        ).alias(name),
    )
