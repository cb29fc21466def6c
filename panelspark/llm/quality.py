"""Quality classifier: a sparse ensemble of rules over statistics of the text.

1. Statistics of every whole text: shares of kinds of characters, words and lines.
2. A random forest over the labelled rows; every path from a root to a node below it is a rule, a conjunction of
   thresholds on statistics.
3. A logistic regression with an L1 penalty weighs the rules; most weights are zero.
4. The rules that are left are compiled into one Spark column: the score.

Label, language, source and id of a document are no statistics. Training uses every labelled row that is not held out;
forest and regression run on Spark. Defined results: null and empty texts have all statistics zero and a score; rows
without a label, or with a null one, do not train; a document with several labels trains with each; without two
different labels to learn from, the score is the smoothed share of the label 1; rows with a null id are not held out.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from panelspark.llm.tables import stored

TREES = 24
DEPTH = 3
PENALTY = 0.0005
SEED = 11

KINDS = ("other", "upper", "lower", "digit", "blank", "line", "stop", "symbol", "mark", "wide", "bar")
STATISTICS = (
    *(f"share_{k}" for k in KINDS[1:]),
    "log_words",
    "word_length",
    "distinct_words",
    "repeated_neighbours",
    "distinct_lines",
    "words_per_line",
    "words_ending_in_symbol",
    "capital_words",
)


def _kind_of_byte() -> np.ndarray:
    out = np.zeros(256, np.int64)
    for kind, members in enumerate((b"", bytes(range(65, 91)), bytes(range(97, 123)), b"0123456789", b" \t", b"\n\r", b".,;:", b"#$%&*@^~<>{}[]\\/_=+", b"!?", b"", b"|")):
        out[list(members)] = kind
    out[128:] = KINDS.index("wide")
    return out


KIND_OF_BYTE = _kind_of_byte()
SYMBOLS = "#$%&*@^~|!"


def statistics_of(text: str) -> list[float]:
    """The statistics of one text, all zero for an empty one."""
    if not text:
        return [0.0] * len(STATISTICS)
    counts = np.bincount(KIND_OF_BYTE[np.frombuffer(text.encode(), np.uint8)], minlength=len(KINDS))
    words, lines = text.split(), text.split("\n")
    n = max(len(words), 1)
    return [
        *(counts[1:] / counts.sum()).tolist(),
        float(np.log1p(len(words))),
        sum(map(len, words)) / n,
        len(set(words)) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        len(set(lines)) / len(lines),
        float(np.log1p(len(words) / len(lines))),
        sum(w[-1] in SYMBOLS for w in words) / n,
        sum(map(str.isupper, words)) / n,
    ]


@F.arrow_udf(ArrayType(DoubleType()))
def statistics(texts: pa.Array) -> pa.Array:
    """The statistics of each text, in the order of STATISTICS."""
    return pa.array([statistics_of(t.as_py() or "") for t in texts], pa.list_(pa.float64()))


def held_out(key: Column) -> Column:
    """Whether the row is kept from training: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, at most, threshold), in order


def paths(tree_text: str) -> set[Rule]:
    """The conjunctions along a tree as Spark prints it: one for every node but the root."""
    found: set[Rule] = set()
    stack: list[tuple[int, tuple[int, bool, float]]] = []
    for line in tree_text.splitlines():
        m = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if m:
            depth = len(m[1])
            while stack and stack[-1][0] >= depth:
                stack.pop()
            stack.append((depth, (int(m[2]), m[3] == "<=", float(m[4]))))
            found.add(tuple(sorted({c for _, c in stack})))
    return found


def condition(rule: Rule, values: Column) -> Column:
    """The rule as a Spark expression over the array of statistics."""
    out = None
    for k, at_most, threshold in rule:
        test = values[k] <= threshold if at_most else values[k] > threshold
        out = test if out is None else out & test
    return out


@dataclass(frozen=True)
class Model:
    """Rules with their weights; what ``score`` compiles."""

    base: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self, values: Column) -> Column:
        total = F.lit(self.base)
        for rule, weight in self.rules:
            total = total + F.when(condition(rule, values), F.lit(weight)).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-total))


def fit(
    rows: DataFrame, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY, seed: int = SEED
) -> Model:
    """Learns from (stats array<double>, label double)."""
    n, ones = rows.agg(F.count("*"), F.sum("label")).first()
    ones = ones or 0.0
    if not 0 < ones < n:
        share = (ones + 1) / (n + 2)
        return Model(float(np.log(share / (1 - share))), ())
    vectors = rows.select("label", "stats", array_to_vector("stats").alias("features"))
    # The rarer label weighs as much in all as the other while trees are grown, so that its rules are found.
    weight = F.when(F.col("label") == 1, n / (2 * ones)).otherwise(n / (2 * (n - ones)))
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=seed, maxBins=64, minInstancesPerNode=5, weightCol="w", featureSubsetStrategy="0.5"
    ).fit(vectors.withColumn("w", weight))
    rules = sorted({r for tree in forest.trees for r in paths(tree.toDebugString)})
    if not rules:
        return Model(float(np.log(ones / (n - ones))), ())
    flags = F.array(*(condition(r, F.col("stats")).cast("double") for r in rules))
    inputs = vectors.select("label", array_to_vector(flags).alias("features"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=60).fit(inputs)
    weights = lasso.coefficients.toArray()
    kept = tuple((r, float(w)) for r, w in zip(rules, weights) if w)
    return Model(float(lasso.intercept), kept)


def trained(stats: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", **settings) -> Model:
    """Learns from the rows of (key, stats) that have a label and are not held out."""
    known = labels.select(F.col(key).alias("id"), F.col(label).cast("double").alias("label")).filter("label in (0, 1)")
    rows = stats.select(F.col(key).alias("id"), "stats").filter(~held_out(F.col("id"))).join(known, "id")
    return fit(stored(rows.select("stats", "label"), "training"), **settings)


def scored(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """Rows (key, held_out, score, predicted), one for each row of the table."""
    stats = stored(df.select(F.col(key), statistics(F.col(text)).alias("stats")), "statistics")
    model = trained(stats, labels, key, **settings)
    out = stats.select(F.col(key), held_out(F.col(key)).alias("held_out"), model.score(F.col("stats")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The rows of the table, all columns, whose predicted label is 1."""
    stats = stored(df.select(F.col(key), statistics(F.col(text)).alias("stats")), "statistics")
    model = trained(stats, labels, key, **settings)
    return df.filter(model.score(statistics(F.col(text))) >= 0.5)

