"""Operator 6: quality rules as learned decision lists.

Each text gives statistics (counts of words, symbols, repeated lines, repeated windows, ...).
Sequential covering learns rules for low quality from labelled rows: a rule grows by the
threshold test with the best information gain until it covers no good row, is pruned on
held-back rows, is kept if it is precise there, and the rows it covers are set aside. The
ordered rules become one conditional Spark expression over the statistics.

Rules are fitted on the driver to a bounded sample of labelled rows (``SAMPLE_ROWS``); the
sample is drawn from the labels by the hash of their ids, and its ids are what is broadcast.
Statistics and verdicts cover every row, in one pass without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.llm.common import clear_name, map_texts
from assay.llm.hashing import SPACED, Powers, hash_words, mix, per_text, windows

SAMPLE_ROWS = 20_000
WINDOW = 5
MAX_RULES = 12
MAX_TESTS = 4
MIN_COVERED = 5
MIN_PRECISION = 0.95
CUTS = 64

STATISTICS = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
    "n_distinct_words", "n_upper", "n_digits", "n_marks",
)
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_MARKS = np.zeros(256, bool)
_MARKS[list(b"!?")] = True


def statistics(texts: list[bytes | None], cache: Powers) -> dict[str, np.ndarray]:
    words = hash_words(texts, SPACED, cache)
    data, n = words.data, len(texts)
    out = {"n_words": words.counts}
    out["word_chars"] = per_text((data != 0x20) & ((data & 0xC0) != 0x80), words)
    out["n_symbols"] = per_text(_SYMBOLS[data], words)
    out["n_upper"] = per_text((data >= 0x41) & (data <= 0x5A), words)
    out["n_digits"] = per_text((data >= 0x30) & (data <= 0x39), words)
    out["n_marks"] = per_text(_MARKS[data], words)
    lines = [[x for x in (t or b"").split(b"\n") if x.strip()] for t in texts]
    out["n_lines"] = np.array([len(x) for x in lines], np.int64)
    out["n_dup_lines"] = np.array([len(x) - len(set(x)) for x in lines], np.int64)
    salt = mix(words.text.astype(np.uint64) + np.uint64(1))
    own = np.sort(words.hash + salt)
    new = np.ones(len(own), bool)
    new[1:] = own[1:] != own[:-1]
    # Distinct words are counted by text through the first of each equal pair.
    order = np.argsort(words.hash + salt, kind="stable")
    out["n_distinct_words"] = np.bincount(words.text[order][new], minlength=n)
    first, hashes = windows(words, WINDOW)
    hashes = hashes + salt[first]
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    twice = np.zeros(len(first), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    change = np.zeros(len(words.hash) + WINDOW + 1, np.int64)
    change[first[twice]] += 1
    change[first[twice] + WINDOW] -= 1
    covered = np.cumsum(change)[: len(words.hash)] > 0
    out["n_repeat_words"] = np.bincount(words.text[covered], minlength=n)
    return out


def _make():
    cache = Powers()
    return lambda texts: statistics(texts, cache)


def with_statistics(documents: DataFrame, *, keep: tuple[str, ...], text: str = "text") -> DataFrame:
    """Columns k0.. for ``keep`` and one long for each of ``STATISTICS``."""
    names = tuple(f"k_{i}" for i in range(len(keep)))
    body = dict(zip(keep, names, strict=True)).get(text, "t_")
    source = documents.select(
        *[F.col(c).alias(n) for c, n in zip(keep, names, strict=True)],
        *([] if body in names else [F.col(text).alias(body)]),
    )
    fields = ", ".join(f"{s} long" for s in STATISTICS)
    return map_texts(source, _make, fields, text=body, keep=names)


def features() -> dict[str, Column]:
    """What the tests of a rule compare, as expressions over the statistics."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    lines = F.greatest(F.col("n_lines"), F.lit(1)).cast("double")
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": F.col("word_chars") / words,
        "symbols_per_word": F.col("n_symbols") / words,
        "marks_per_word": F.col("n_marks") / words,
        "repeated_lines": F.col("n_dup_lines") / lines,
        "repeated_words": F.col("n_repeat_words") / words,
        "distinct_words": F.col("n_distinct_words") / words,
        "upper_share": F.col("n_upper") / chars,
        "digit_share": F.col("n_digits") / chars,
    }


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    cut: float

    def covers(self, rows: dict[str, np.ndarray]) -> np.ndarray:
        return rows[self.feature] > self.cut if self.above else rows[self.feature] <= self.cut

    def column(self, known: dict[str, Column]) -> Column:
        value = known[self.feature]
        return value > self.cut if self.above else value <= self.cut


Rule = tuple[Test, ...]


def covered_by(rule: Rule, rows: dict[str, np.ndarray], n: int) -> np.ndarray:
    hit = np.ones(n, bool)
    for test in rule:
        hit &= test.covers(rows)
    return hit


def _grow(rows: dict[str, np.ndarray], low: np.ndarray, cuts: dict[str, np.ndarray]) -> Rule:
    rule: list[Test] = []
    alive = np.ones(len(low), bool)
    while len(rule) < MAX_TESTS and (~low & alive).any():
        p0, n0 = (low & alive).sum(), (~low & alive).sum()
        best = (0.0, None)
        for feature, values in cuts.items():
            at = np.searchsorted(values, rows[feature][alive], side="left")
            good, bad = (
                np.bincount(at[mask], minlength=len(values) + 1)
                for mask in (low[alive], ~low[alive])
            )
            for above in (False, True):
                p = np.cumsum(good)[:-1]
                n = np.cumsum(bad)[:-1]
                if above:
                    p, n = p0 - p, n0 - n
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
                gain = np.where(p >= 1, gain, -1.0)
                i = int(np.argmax(gain)) if len(gain) else 0
                if len(gain) and gain[i] > best[0] + 1e-9:
                    best = (float(gain[i]), Test(feature, above, float(values[i])))
        if best[1] is None:
            break
        test = _centred(best[1], rows[best[1].feature][alive])
        rule.append(test)
        alive &= test.covers(rows)
    return tuple(rule)


def _centred(test: Test, values: np.ndarray) -> Test:
    """The same split with its cut halfway between the values on its two sides."""
    upper, lower = values[values > test.cut], values[values <= test.cut]
    if not len(upper) or not len(lower):
        return test
    return Test(test.feature, test.above, float((upper.min() + lower.max()) / 2))


def _prune(rule: Rule, rows: dict[str, np.ndarray], low: np.ndarray) -> Rule:
    def worth(candidate: Rule) -> float:
        hit = covered_by(candidate, rows, len(low))
        p, n = (hit & low).sum(), (hit & ~low).sum()
        return (p - n) / (p + n) if p + n else -1.0

    best, value = rule, worth(rule)
    for size in range(len(rule) - 1, 0, -1):
        if (now := worth(rule[:size])) >= value:
            best, value = rule[:size], now
    return best


def learn_rules(rows: dict[str, np.ndarray], low: np.ndarray) -> list[Rule]:
    """Ordered rules for the rows marked ``low``; none where nothing precise can be learned."""
    if not len(low) or not low.any() or low.all():
        return []
    held_back = np.arange(len(low)) % 3 == 0
    grow, prune = ~held_back, held_back
    rules: list[Rule] = []
    for _ in range(MAX_RULES):
        if (low & grow).sum() < MIN_COVERED:
            break
        inside = {f: v[grow] for f, v in rows.items()}
        cuts = {f: np.unique(np.quantile(v, np.linspace(0, 1, CUTS))) for f, v in inside.items()}
        cuts = {
            f: np.unique(
                np.concatenate([c, np.quantile(inside[f][low[grow]], np.linspace(0, 1, CUTS))])
            )
            for f, c in cuts.items()
        }
        rule = _grow(inside, low[grow], cuts)
        if not rule:
            break
        rule = _prune(rule, {f: v[prune] for f, v in rows.items()}, low[prune])
        every = covered_by(rule, rows, len(low))
        p, n = (every & low & (grow | prune)).sum(), (every & ~low & (grow | prune)).sum()
        if p < MIN_COVERED or p < MIN_PRECISION * (p + n):
            break
        rules.append(rule)
        grow, prune = grow & ~every, prune & ~every
    return rules


def verdict(rules: list[Rule]) -> Column:
    """Number (from 1) of the first rule that covers a row, 0 if none does."""
    known = features()
    expression: Column | None = None
    for number, rule in enumerate(rules, 1):
        condition = F.lit(True)
        for test in rule:
            condition = condition & test.column(known)
        if expression is None:
            expression = F.when(condition, F.lit(number))
        else:
            expression = expression.when(condition, F.lit(number))
    return F.lit(0) if expression is None else expression.otherwise(F.lit(0))


def fit_rules(
    documents: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> list[Rule]:
    """Rules learned from at most ``sample_rows`` labelled rows; a row is low where its label is 0.

    Labels of one id that disagree count as low; null ids and labels are left out.
    """
    chosen = (
        labels.select(F.col(key).alias("k_"), F.col(label).cast("long").alias("l_"))
        .dropna()
        .groupBy("k_")
        .agg(F.min("l_").alias("l_"))
        .orderBy(F.xxhash64("k_"), "k_")
        .limit(sample_rows)
    )
    # At most sample_rows pairs of numbers: a bounded broadcast.
    sample = documents.select(F.col(key).alias("k_"), F.col(text).alias("t_")).join(
        F.broadcast(chosen), "k_"
    )
    found = (
        with_statistics(sample, keep=("k_", "l_"), text="t_")
        .select(
            F.col("k_0").alias("k_"),
            F.col("k_1").alias("l_"),
            *[c.alias(name) for name, c in features().items()],
        )
        .orderBy(F.xxhash64("k_"), "k_", *features())
        .limit(sample_rows)
        .toPandas()
    )
    rows = {name: found[name].to_numpy(float) for name in features()}
    return learn_rules(rows, found["l_"].to_numpy(int) == 0)


def apply_rules(
    documents: DataFrame,
    rules: list[Rule],
    *,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    name: str = "quality_rules",
) -> DataFrame:
    """The columns ``keep`` of each row and a struct column ``name``.

    The struct holds the statistics; base_failed (fewer than 10 words, or more than a fifth of
    them in windows found twice); rule (the first learned rule that covers the row, 0 if none);
    kept (neither base_failed nor covered). A null or empty text has no words and fails. Rows
    are independent: repeated rows or ids and further columns change nothing.
    """
    scored = with_statistics(documents, keep=keep, text=text)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rule = verdict(rules)
    return scored.select(
        *[F.col(f"k_{i}").alias(c) for i, c in enumerate(keep)],
        F.struct(
            *STATISTICS,
            failed.alias("base_failed"),
            rule.alias("rule"),
            (~failed & (rule == 0)).alias("kept"),
        ).alias(name),
    )


def keep_good(documents: DataFrame, labels: DataFrame, **names) -> DataFrame:
    """The rows of ``documents`` that pass, with their columns."""
    rules = fit_rules(documents, labels, **names)
    found = clear_name(documents, "quality_rules")
    judged = apply_rules(documents, rules, keep=tuple(documents.columns), name=found)
    return judged.where(F.col(f"{found}.kept")).drop(found)
