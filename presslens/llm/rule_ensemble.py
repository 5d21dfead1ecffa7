"""Quality classifier: a sparse ensemble of rules over text statistics, scored as a Spark column expression.

`statistics` are numbers of a text made by column functions. Short boosted trees are grown on them; each path from a
tree's root to a node is a rule, a conjunction of ranges of statistics. A lasso logistic regression gives each rule a
weight, zero for most. The rules that are left are compiled into one column expression, so all documents are scored
by Spark itself, whole and without a shuffle; only statistics and rules decide, never label, language, source or id.

The model is fitted on a bounded sample: of each class at most `SAMPLE` labelled rows, those with the smallest hashes
of their ids. Their statistics, some 20 numbers a row, are all that reaches the driver. Rows are weighted so that the
classes keep their shares among all labels.

Defined results: a null text counts as an empty one, whose statistics are 0; null ids are scored, and held out if the
crc32 of an empty text leaves no remainder, that is always; repeated rows are scored alike, and several labels of one
id count as the lowest; without labels of both classes every score is the share of label 1, or 0.5 without any label;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.llm.common import words_of

FOLDS = 5
# Labelled rows of a class that a model is fitted on.
SAMPLE = 3000
THRESHOLD = 0.3
TREES = 40
DEPTH = 3
# Share of the weight that a side of a split needs, and how many cut points are tried for a statistic.
LEAST_SHARE = 0.005
CUTS = 48
RATE = 0.3
# Strengths of the lasso that are tried, strong ones first; the one that predicts the rows left out best is taken.
STRENGTHS = (0.03, 0.01, 0.003, 0.001, 0.0003)
STEPS = 200


def held_out(id_column: Column, folds: int = FOLDS) -> Column:
    """Whether the crc32 of the id as text leaves no remainder."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % folds == 0


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0)).cast("double")


def _count(text: Column, characters: str) -> Column:
    """How many characters of a class a text has."""
    return F.length(text) - F.length(F.regexp_replace(text, f"[{characters}]+", ""))


def _statistics(t: Column, w: Column, l: Column) -> dict[str, Column]:  # noqa: E741
    """The statistics of a text, from it, its words and its lines."""
    return {
        "characters": F.length(t).cast("double"),
        "words": F.size(w).cast("double"),
        "lines": F.size(l).cast("double"),
        "word_length": _share(F.length(F.concat_ws("", w)), F.size(w)),
        "longest_word": F.coalesce(F.array_max(F.transform(w, F.length)), F.lit(0)).cast("double"),
        "short_words": _share(F.size(F.filter(w, lambda word: F.length(word) <= 3)), F.size(w)),
        "distinct_words": _share(F.size(F.array_distinct(w)), F.size(w)),
        "repeated_words": _share(F.regexp_count(t, F.lit(r"(?<!\S)(\S++)(?=\s+\1(?!\S))")), F.size(w)),
        "distinct_lines": _share(F.size(F.array_distinct(l)), F.size(l)),
        "letters": _share(_count(t, r"\p{L}"), F.length(t)),
        "capitals": _share(_count(t, r"\p{Lu}"), F.length(t)),
        "digits": _share(_count(t, "0-9"), F.length(t)),
        "symbols": _share(_count(t, r"#*$%&|<>{}\[\]\\^~=_+@/"), F.length(t)),
        "exclamations": _share(_count(t, "!"), F.size(w)),
        "sentence_ends": _share(_count(t, ".?"), F.size(w)),
        "commas": _share(_count(t, ",;:"), F.size(w)),
    }


# The names of the statistics, in order.
STATISTICS = tuple(
    "characters words lines word_length longest_word short_words distinct_words repeated_words distinct_lines "
    "letters capitals digits symbols exclamations sentence_ends commas".split()
)


def with_statistics(rows: DataFrame, *keep: str) -> DataFrame:
    """The columns to keep of `rows` (text, ...) and the statistics, under the names of `STATISTICS`.

    Text, words and lines are columns of a select of their own, so that no statistic makes them again.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    made = rows.select(*keep, text.alias("t"))
    made = made.select(*keep, "t", words_of(F.col("t")).alias("w"), F.split("t", "\n").alias("l"))
    made_of = _statistics(F.col("t"), F.col("w"), F.col("l"))
    return made.select(*keep, *[made_of[name].alias(name) for name in STATISTICS])


@dataclass(frozen=True)
class Rule:
    """A conjunction of ranges: statistic -> (above, at most), either of them None where it is open."""

    ranges: tuple[tuple[str, float | None, float | None], ...]

    def column(self) -> Column:
        """Whether the rule holds, from columns named as the statistics."""
        holds = F.lit(True)
        for name, above, most in self.ranges:
            holds = holds & (F.col(name) > above) if above is not None else holds
            holds = holds & (F.col(name) <= most) if most is not None else holds
        return holds

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        rows = np.ones(len(next(iter(values.values()))), bool)
        for name, above, most in self.ranges:
            rows &= values[name] > above if above is not None else True
            rows &= values[name] <= most if most is not None else True
        return rows

    def __str__(self) -> str:
        parts = [f"{a} < {n}" if m is None else f"{n} <= {m}" if a is None else f"{a} < {n} <= {m}" for n, a, m in self.ranges]
        return " and ".join(parts)


@dataclass
class Ensemble:
    """Weighted rules; the score is the logistic function of the sum of the weights of the rules that hold."""

    base: float
    rules: list[tuple[Rule, float]] = field(default_factory=list)

    def column(self) -> Column:
        """The score, as an expression over columns named as the statistics."""
        total = F.lit(self.base)
        for rule, weight in self.rules:
            total = total + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


class _Tree:
    """One regression tree on binned statistics; it keeps the path to each of its nodes."""

    def __init__(self, bins: np.ndarray, slope: np.ndarray, curve: np.ndarray, features: np.ndarray):
        self.bins, self.slope, self.curve, self.features = bins, slope, curve, features
        self.least = LEAST_SHARE * curve.sum()
        self.paths: list[tuple[tuple[int, int, bool], ...]] = []
        self.value = np.zeros(len(slope))
        self._grow(np.arange(len(slope)), ())

    def _grow(self, rows: np.ndarray, path: tuple) -> None:
        if path:
            self.paths.append(path)
        slope, curve = self.slope[rows], self.curve[rows]
        total, weight = slope.sum(), curve.sum()
        self.value[rows] = total / (weight + 1e-3 * self.curve.sum())
        if len(path) == DEPTH:
            return
        best = (1e-9 * self.curve.sum(), -1, -1)
        for f in self.features:
            of = self.bins[rows, f]
            left = np.bincount(of, slope, CUTS + 1).cumsum()[:-1]
            under = np.bincount(of, curve, CUTS + 1).cumsum()[:-1]
            fits = (under >= self.least) & (weight - under >= self.least)
            gain = left**2 / np.maximum(under, 1e-12) + (total - left) ** 2 / np.maximum(weight - under, 1e-12)
            gain = np.where(fits, gain - total**2 / weight, -1.0)
            cut = int(np.argmax(gain))
            if gain[cut] > best[0]:
                best = (gain[cut], f, cut)
        _, f, cut = best
        if f >= 0:
            low = self.bins[rows, f] <= cut
            self._grow(rows[low], (*path, (f, cut, True)))
            self._grow(rows[~low], (*path, (f, cut, False)))


def grown_rules(values: np.ndarray, names: list[str], label: np.ndarray, weight: np.ndarray) -> list[Rule]:
    """The rules of all paths of boosted trees that fit the labels."""
    cuts = []
    for column in values.T:
        distinct = np.unique(column)
        middles = (distinct[1:] + distinct[:-1]) / 2
        cuts.append(middles[np.unique(np.linspace(0, len(middles) - 1, CUTS).astype(int))] if len(middles) else middles)
    bins = np.stack([np.searchsorted(c, column, "left") for c, column in zip(cuts, values.T)], 1)
    rng = np.random.default_rng(20240301)
    share = np.average(label, weights=weight)
    odds, rules = np.full(len(label), np.log(share / (1 - share))), {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-odds))
        # Each tree sees half the rows and half the statistics, so that their paths differ.
        seen = weight * (rng.random(len(label)) < 0.5)
        features = rng.permutation(len(names))[: (len(names) + 1) // 2]
        tree = _Tree(bins, seen * (label - p), seen * p * (1 - p) + 1e-12, features)
        odds = np.clip(odds + RATE * np.clip(tree.value, -4, 4), -12, 12)
        for path in tree.paths:
            bounds: dict[int, list[float | None]] = {}
            for f, cut, low in path:
                above, most = bounds.setdefault(f, [None, None])
                at = float(cuts[f][cut])
                bounds[f] = [above, at if most is None else min(most, at)] if low else [at if above is None else max(above, at), most]
            rules[Rule(tuple((names[f], *bounds[f]) for f in sorted(bounds)))] = None
    return list(rules)


def lasso(design: np.ndarray, label: np.ndarray, weight: np.ndarray, strength: float, start: np.ndarray) -> np.ndarray:
    """Weights (the last one, of a column of ones, is free) of a logistic regression under an absolute penalty.

    Accelerated proximal gradient steps; the step length is the inverse of a bound of the curvature.
    """
    weight = weight / weight.sum()
    bound = max(0.25 * float(np.linalg.eigvalsh((design * weight[:, None]).T @ design)[-1]), 1e-9)
    penalty = np.full(design.shape[1], strength / bound)
    penalty[-1] = 0
    current, ahead, pace = start, start, 1.0
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(design @ ahead, -30, 30)))
        moved = ahead - design.T @ (weight * (p - label)) / bound
        after = np.sign(moved) * np.maximum(np.abs(moved) - penalty, 0)
        faster = (1 + np.sqrt(1 + 4 * pace**2)) / 2
        ahead, current, pace = after + (pace - 1) / faster * (after - current), after, faster
    return current


def constant(share: float) -> Ensemble:
    """No rules: one score for all texts."""
    return Ensemble(float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))))


def fit(values: np.ndarray, label: np.ndarray, weight: np.ndarray) -> Ensemble:
    """The ensemble of rows of statistics, in the order of `STATISTICS`, with labels 0 and 1 and weights."""
    names = list(STATISTICS)
    if len(set(label)) < 2:
        return constant(float(label[0]) if len(label) else 0.5)
    share = float(np.average(label, weights=weight))
    rules = grown_rules(values, names, label, weight)
    columns = dict(zip(names, values.T))
    # Rules that hold for the same rows of the sample are one; the shortest speaks for them.
    apart: dict[bytes, Rule] = {}
    for rule in sorted(rules, key=lambda r: len(r.ranges)):
        apart.setdefault(np.packbits(rule.holds(columns)).tobytes(), rule)
    rules = list(apart.values())
    design = np.stack([*(r.holds(columns) for r in rules), np.ones(len(label), bool)], 1).astype(float)
    out = np.arange(len(label)) % 5 == 0
    best, first = (np.inf, STRENGTHS[-1]), np.zeros(design.shape[1])
    first[-1] = np.log(share / (1 - share))
    start = first
    if 0 < label[~out].sum() < (~out).sum():
        for strength in STRENGTHS:
            start = lasso(design[~out], label[~out], weight[~out], strength, start)
            odds = np.clip(design[out] @ start, -30, 30)
            loss = np.average(np.logaddexp(0, odds) - label[out] * odds, weights=weight[out])
            # A weaker one must be better by more than a trifle, as it takes more rules.
            if loss < best[0] - 2e-3:
                best = (float(loss), strength)
    found = first
    for strength in STRENGTHS[: STRENGTHS.index(best[1]) + 1]:
        found = lasso(design, label, weight, strength, found)
    kept = [(rule, float(w)) for rule, w in zip(rules, found[:-1]) if abs(w) > 1e-6]
    return Ensemble(float(found[-1]), kept)


def fit_ensemble(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ensemble:
    """Fit on a bounded sample of labelled documents (doc_id, text; doc_id, quality) that are not held out."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    counts = dict(known.groupBy("quality").count().collect())
    # At most `sample` ids of a class are broadcast, then at most as many rows of it are kept, however often ids repeat.
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = [known.where(F.col("quality") == c).orderBy(*order).limit(sample) for c in (0, 1)]
    rows = docs.select("doc_id", "text").join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id")
    rows = with_statistics(rows, "doc_id", "quality")
    order = [F.xxhash64("doc_id"), *[F.col(c) for c in ("doc_id", *STATISTICS)]]
    halves = [rows.where(F.col("quality") == c).orderBy(*order).limit(sample) for c in (0, 1)]
    held = halves[0].unionByName(halves[1]).orderBy(*order).drop("doc_id").collect()
    table = np.array([tuple(r) for r in held], float).reshape(len(held), 1 + len(STATISTICS))
    label = table[:, 0]
    seen = {c: int((label == c).sum()) for c in (0, 1)}
    if not all(seen.values()):
        return constant(counts.get(1, 0) / sum(counts.values()) if counts else 0.5)
    return fit(table[:, 1:], label, np.where(label == 1, counts[1] / seen[1], counts[0] / seen[0]))


def score(docs: DataFrame, ensemble: Ensemble) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, held_out and score."""
    rows = with_statistics(docs, "doc_id")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), ensemble.column().alias("score"))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of `docs` (doc_id, text) whether it was held out, its score and the prediction."""
    rows = docs.select("doc_id", "text")
    scored = score(rows, fit_ensemble(rows, labels))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
