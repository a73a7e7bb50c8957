"""Operator 10: toxicity as a severity grade, by cumulative-link ordinal regression.

The model is P(grade <= k) = logistic(threshold_k - x.w): one weight vector shared by ordered
thresholds, so a word moves a text along one scale. Features are sparse: for each word of the
text, log(1 + occurrences), words being compared by 64-bit hash. Weights are fitted with an L1
penalty, so a few hundred words remain, and scoring a text is one lookup per word.

The model is fitted on the driver to a bounded sample of labelled rows (``SAMPLE_ROWS``), drawn
from the labels by the hash of their ids. Scoring covers every row in one pass without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm.common import map_texts
from assay.llm.decontaminate import _FOLD
from assay.llm.hashing import Powers, hash_words

SAMPLE_ROWS = 12_000
GRADES = 4
# A word enters the fit if this many sampled texts hold it and its share among toxic ones differs
# from that among clean ones by so many standard errors; the penalty then drops more.
MIN_TEXTS = 5
MIN_ERRORS = 5.0
PENALTY = 1e-4
STEPS = 400
RATE = 0.1
# Odds against clean texts from which a word counts towards the grade of a toxic text.
GRADING_ODDS = 20.0


@dataclass(frozen=True)
class OrdinalModel:
    words: np.ndarray  # sorted word hashes
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one fewer than grades

    def at_most(self, scores: np.ndarray) -> np.ndarray:
        """P(grade <= k) for each score and threshold."""
        return 1 / (1 + np.exp(-np.clip(self.thresholds[None, :] - scores[:, None], -40, 40)))

    def severity(self, scores: np.ndarray) -> np.ndarray:
        """Expected grade: the sum over thresholds of the probability to be above them."""
        return (1 - self.at_most(scores)).sum(axis=1)


def _entries(texts, cache: Powers, known: np.ndarray | None = None):
    """(text, word hash, occurrences) of distinct words of each text; only ``known`` ones if given."""
    words = hash_words(texts, _FOLD, cache)
    hashes, text = words.hash, words.text
    if known is not None:
        at = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
        hit = known[at] == hashes if len(known) else np.zeros(len(hashes), bool)
        hashes, text = hashes[hit], text[hit]
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return text[at], hashes[at], np.diff(np.append(at, len(hashes))), words.counts


def _make_features():
    cache = Powers()

    def call(texts):
        text, hashes, times, counts = _entries(texts, cache)
        bounds = np.searchsorted(text, np.arange(len(texts) + 1))
        pairs = list(zip(bounds, bounds[1:], strict=False))
        return {
            "n_words": counts,
            "words": [hashes[a:b].view(np.int64) for a, b in pairs],
            "times": [times[a:b].astype(np.int32) for a, b in pairs],
        }

    return call


def _fit(values, rows, columns, n_rows: int, n_columns: int, grades: np.ndarray, n_grades: int):
    """Weights and thresholds by proximal steps scaled per feature on the mean log loss."""
    share = np.array([(grades <= k).mean() for k in range(n_grades - 1)])
    share = np.clip(share, 1 / (n_rows + 1), 1 - 1 / (n_rows + 1))
    thresholds = np.log(share / (1 - share))
    weights = np.zeros(n_columns)
    n_all = n_columns + n_grades - 1
    mean, square = np.zeros(n_all), np.zeros(n_all)
    for step in range(1, STEPS + 1):
        score = np.bincount(rows, weights=values * weights[columns], minlength=n_rows)
        upper = np.concatenate([thresholds, [np.inf]])[grades] - score
        lower = np.concatenate([[-np.inf], thresholds])[grades] - score
        p_upper, p_lower = (1 / (1 + np.exp(-np.clip(x, -40, 40))) for x in (upper, lower))
        p_upper, p_lower = np.where(np.isinf(upper), 1, p_upper), np.where(np.isinf(lower), 0, p_lower)
        mass = np.maximum(p_upper - p_lower, 1e-9)
        d_upper, d_lower = p_upper * (1 - p_upper) / mass, p_lower * (1 - p_lower) / mass
        slope = (d_upper - d_lower) / n_rows  # of the loss in the score
        gradient = np.bincount(columns, weights=values * slope[rows], minlength=n_columns)
        towards = np.bincount(grades, weights=d_upper, minlength=n_grades)[: n_grades - 1]
        away = np.bincount(grades, weights=d_lower, minlength=n_grades)[1:]
        gradient_t = (away - towards) / n_rows
        both = np.concatenate([gradient, gradient_t])
        mean = 0.9 * mean + 0.1 * both
        square = 0.99 * square + 0.01 * both**2
        scale = RATE * (1 - step / (STEPS + 1)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        move = scale * mean / (1 - 0.9**step)
        weights = weights - move[:n_columns]
        shrink = scale[:n_columns] * PENALTY
        weights = np.sign(weights) * np.maximum(np.abs(weights) - shrink, 0)
        thresholds = np.sort(thresholds - move[n_columns:])
    return weights, thresholds


def fit_model(
    documents: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    grades: int = GRADES,
    sample_rows: int = SAMPLE_ROWS,
) -> OrdinalModel:
    """The model fitted to at most ``sample_rows`` labelled rows.

    ``label`` is a grade from 0 to ``grades`` - 1, or only 0 and 1: then the toxic rows are
    graded from 1 up by how much they hold of words that clean rows hardly ever hold, in groups
    of about equal number. Labels of one id that disagree count as the highest; null ids and labels
    are left out. Without labelled rows of both kinds every text has severity 0.
    """
    chosen = (
        labels.select(F.col(key).alias("k_"), F.col(label).cast("long").alias("l_"))
        .dropna()
        .groupBy("k_")
        .agg(F.max("l_").alias("l_"))
        .orderBy(F.xxhash64("k_"), "k_")
        .limit(sample_rows)
    )
    # At most sample_rows pairs of numbers: a bounded broadcast.
    sample = documents.select(F.col(key).alias("k_"), F.col(text).alias("t_")).join(
        F.broadcast(chosen), "k_"
    )
    table = (
        map_texts(
            sample, _make_features, "n_words long, words array<long>, times array<int>",
            text="t_", keep=("k_", "l_"),
        )
        .orderBy(F.xxhash64("k_"), "k_", F.xxhash64("words"))
        .limit(sample_rows)
        .toArrow()
    )
    nothing = OrdinalModel(np.zeros(0, np.uint64), np.zeros(0), np.full(grades - 1, np.inf))
    given = np.array(table["l_"].to_pylist(), np.int64)
    if not len(given) or given.min() == given.max():
        return nothing
    given = np.clip(given, 0, grades - 1)
    lists = table["words"].combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    hashes = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    times = table["times"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(given)), sizes)
    known, columns, held = np.unique(hashes, return_inverse=True, return_counts=True)
    toxic = given > 0
    n_toxic, n_clean = toxic.sum(), (~toxic).sum()
    with_word = np.bincount(columns, weights=toxic[rows], minlength=len(known))
    share = held / len(given)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n_toxic + 1 / n_clean))
    apart = (with_word / n_toxic - (held - with_word) / n_clean) / spread
    usual = (held >= MIN_TEXTS) & (np.abs(apart) >= MIN_ERRORS)
    if given.max() == 1 and grades > 2:
        odds = (with_word / n_toxic) / ((held - with_word + 0.5) / n_clean)
        severe = usual & (odds >= GRADING_ODDS)
        amount = np.bincount(rows, weights=np.log1p(times) * severe[columns], minlength=len(given))
        cuts = np.quantile(amount[toxic], np.linspace(0, 1, grades)[1:-1])
        given = np.where(toxic, 1 + np.searchsorted(cuts, amount, side="left"), 0)
        given = np.clip(given, 0, grades - 1)
    renumber = np.cumsum(usual) - 1
    inside = usual[columns]
    weights, thresholds = _fit(
        np.log1p(times[inside].astype(float)), rows[inside], renumber[columns[inside]],
        len(given), int(usual.sum()), given, grades,
    )
    used = np.abs(weights) > 1e-6
    return OrdinalModel(known[usual][used], weights[used], thresholds)


def _make_scores(model: OrdinalModel):
    def make():
        cache = Powers()

        def call(texts):
            text, hashes, times, counts = _entries(texts, cache, model.words)
            at = np.searchsorted(model.words, hashes)
            score = np.bincount(
                text, weights=np.log1p(times) * model.weights[at], minlength=len(texts)
            )
            score = score.astype(float)
            above = 1 - model.at_most(score)
            return {
                "n_words": counts,
                "severity": above.sum(axis=1),
                "p_toxic": above[:, 0],
                "grade": (above >= 0.5).sum(axis=1),
            }

        return call

    return make


def score_toxicity(
    documents: DataFrame,
    model: OrdinalModel,
    *,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
) -> DataFrame:
    """The columns ``keep`` of each row and a struct column ``toxicity``.

    ``toxicity``: n_words; severity (expected grade); p_toxic (probability of a grade above 0);
    grade (the median grade); toxic (p_toxic of a half or more). A null or empty text has no
    words and the severity that the model gives to no evidence. Rows are independent: repeated
    rows or ids and further columns change nothing.
    """
    names = tuple(f"c{i}" for i in range(len(keep)))
    source = documents.select(
        *[F.col(c).alias(n) for c, n in zip(keep, names, strict=True)], F.col(text).alias("body")
    )
    fields = "n_words long, severity double, p_toxic double, grade int"
    scored = map_texts(source, _make_scores(model), fields, text="body", keep=names)
    return scored.select(
        *[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)],
        F.struct(
            "n_words", "severity", "p_toxic", "grade", (F.col("p_toxic") >= 0.5).alias("toxic")
        ).alias("toxicity"),
    )
