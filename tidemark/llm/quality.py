"""Quality scores from a sparse rule ensemble.

Statistics of a text are Spark columns. A random forest over them gives candidate rules: every path from a root is a
conjunction of comparisons. A lasso logistic regression gives each rule a weight and most of them none; the rules
left are compiled into one Spark column expression, so that scoring is a single pass without a model at hand.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

#: At most about so many labelled rows are learned from, drawn by a hash of their id.
SAMPLE = 20_000
TREES, DEPTH = 24, 3
#: The lasso's penalty, and the smallest share of rows that a rule must hold for and must not hold for.
PENALTY, SUPPORT = 0.001, 0.002

STATISTICS = ["words", "word_length", "distinct", "upper", "symbols", "bars", "digits", "lines_again", "stops", "shouts", "commas"]


def with_statistics(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns to keep, with STATISTICS of the whole text; all of them are 0 for an empty or null text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    cut = docs.select(
        *keep,
        text.alias("__text"),
        F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "").alias("__words"),
        F.array_remove(F.split(text, r"\n"), "").alias("__lines"),
    )
    n = F.greatest(F.size("__words"), F.lit(1))
    signs = F.greatest(F.length("__text"), F.lit(1))
    count = lambda pattern: F.regexp_count("__text", F.lit(pattern))
    single = lambda sign: F.length("__text") - F.length(F.replace(F.col("__text"), F.lit(sign), F.lit("")))
    return cut.select(
        *keep,
        F.log1p(F.size("__words")).alias("words"),
        (F.length("__text") / n).alias("word_length"),
        (F.size(F.array_distinct("__words")) / n).alias("distinct"),
        (count(r"\p{Lu}") / signs).alias("upper"),
        (count(r"[^\p{L}\p{N}\s.,!?'|-]") / n).alias("symbols"),
        (single("|") / n).alias("bars"),
        (count("[0-9]") / signs).alias("digits"),
        F.when(F.size("__lines") > 0, 1 - F.size(F.array_distinct("__lines")) / F.size("__lines")).otherwise(F.lit(0.0)).alias("lines_again"),
        ((single(".") + single("?")) / n).alias("stops"),
        (single("!") / n).alias("shouts"),
        (single(",") / n).alias("commas"),
    )


@dataclass(frozen=True)
class Rule:
    """Bounds of statistics: low < value <= high for every (name, low, high)."""

    bounds: tuple[tuple[str, float, float], ...]

    def column(self) -> F.Column:
        parts = [F.col(n) > low for n, low, _ in self.bounds if low > float("-inf")] + [F.col(n) <= high for n, _, high in self.bounds if high < float("inf")]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole & part
        return whole

    def __str__(self) -> str:
        return " and ".join(f"{low:.4g} < {n} <= {high:.4g}" for n, low, high in self.bounds)


def tree_rules(forest, names: list[str]) -> list[Rule]:
    """The distinct paths from the roots of a forest to all their nodes."""
    found: dict[Rule, None] = {}

    def walk(node, box: dict[str, tuple[float, float]]) -> None:
        if box:
            found[Rule(tuple((n, *box[n]) for n in sorted(box)))] = None
        if node.getClass().getSimpleName() != "InternalNode":
            return
        name, cut = names[node.split().featureIndex()], node.split().threshold()
        low, high = box.get(name, (float("-inf"), float("inf")))
        walk(node.leftChild(), box | {name: (low, min(high, cut))})
        walk(node.rightChild(), box | {name: (max(low, cut), high)})

    for tree in forest.trees:
        walk(tree._call_java("rootNode"), {})
    return list(found)


@dataclass
class RuleEnsemble:
    intercept: float
    rules: list[tuple[Rule, float]]

    def score(self) -> F.Column:
        """The probability of label 1, over columns with the names of STATISTICS."""
        total = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            total = total + F.when(rule.column(), F.lit(float(weight))).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def learn_rules(examples: DataFrame, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY) -> RuleEnsemble:
    """Rules and weights from STATISTICS and a 0/1 column label.

    With one label only the score is constant and near it; without examples it is 0.5.
    """
    n, ones = examples.agg(F.count("*"), F.sum("label")).first()
    if not n or not 0 < ones < n:
        share = 0.5 if not n else 0.01 + 0.98 * ones / n
        return RuleEnsemble(math.log(share / (1 - share)), [])
    vectors = VectorAssembler(inputCols=STATISTICS, outputCol="features").transform(examples)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=64, seed=7, featureSubsetStrategy="sqrt").fit(vectors)
    rules = tree_rules(forest, STATISTICS)
    held = examples.select("label", *[r.column().cast("double").alias(f"r{i}") for i, r in enumerate(rules)])
    share = held.agg(*[F.avg(f"r{i}") for i in range(len(rules))]).first()
    used = [i for i in range(len(rules)) if SUPPORT <= share[i] <= 1 - SUPPORT]
    table = VectorAssembler(inputCols=[f"r{i}" for i in used], outputCol="features").transform(held).select("label", "features")
    fit = LogisticRegression(regParam=penalty, elasticNetParam=1.0, maxIter=60).fit(table)
    weights = fit.coefficients.toArray()
    return RuleEnsemble(float(fit.intercept), [(rules[i], float(w)) for i, w in zip(used, weights) if abs(w) > 1e-9])


def draw_examples(docs: DataFrame, labels: DataFrame, label_col: str = "quality", limit: int = SAMPLE) -> DataFrame:
    """STATISTICS and label of about ``limit`` labelled rows at most; all of them if there are no more.

    The ids drawn are few enough to broadcast, so the texts are only filtered. Null ids and labels teach nothing; an id with several labels or texts gives each pair.
    """
    known = labels.select(F.col("doc_id").alias("__id"), F.col(label_col).cast("double").alias("label")).filter("__id is not null and label is not null")
    share = min(1.0, limit / max(1, known.count()))
    drawn = stage(known.filter(F.pmod(F.xxhash64("__id"), F.lit(1 << 40)) < int(share * (1 << 40))), "examples")
    texts = docs.join(drawn, F.col("doc_id") == F.col("__id")).select("text", "label")
    return stage(with_statistics(texts, keep=("label",)), "statistics")


def score_quality(docs: DataFrame, ensemble: RuleEnsemble, threshold: float = 0.3, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per row of ``docs``: the columns to keep, score (0 to 1, higher: label 1 likelier), predicted (1 from ``threshold`` on).

    Empty and null texts are scored by their statistics, which are 0. Nothing is shuffled.
    """
    scored = with_statistics(docs, keep=keep).select(*keep, ensemble.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
