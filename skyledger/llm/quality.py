"""Quality classifier: a sparse rule ensemble compiled into Spark columns.

Statistics of whole texts are built-in expressions. Trees fitted on a bounded
sample of labelled rows give their root-to-node paths as conjunctive rules; an
L1 logistic regression weighs the rules and drops most; those left become one
column expression.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm import text as tx
from skyledger.llm.store import save
from skyledger.llm.toxicity import held_out

SAMPLE = 3_000            # labelled rows of each class that fitting reads at most
TREES, DEPTH, L1 = 12, 3, 0.002
THRESHOLD = 0.3


def statistics(text: Column) -> dict[str, Column]:
    """Counts of a whole text as ratios; 0 where the text is empty."""
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    def share(mark: str) -> Column:
        return (F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))) / n
    words = F.filter(F.split(text, tx.SPACE_SQL), lambda w: w != "")
    lines = F.split(text, "\n")
    n_words = F.size(words).cast("double")
    return {
        "n_words": n_words,
        "word_length": n / F.greatest(n_words, F.lit(1.0)),
        "distinct_words": F.size(F.array_distinct(words)) / F.greatest(n_words, F.lit(1.0)),
        "distinct_lines": F.size(F.array_distinct(lines)) / F.size(lines).cast("double"),
        "line_length": n / F.size(lines).cast("double"),
        "upper": (F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", ""))) / n,
        "digits": (F.length(text) - F.length(F.regexp_replace(text, "[0-9]+", ""))) / n,
        "bangs": share("!"), "bars": share("|"), "percents": share("%"), "stars": share("*"),
        "dollars": share("$"), "ands": share("&"), "hashes": share("#"), "stops": share("."), "commas": share(","),
    }


NAMES = [
    "n_words", "word_length", "distinct_words", "distinct_lines", "line_length", "upper", "digits", "bangs", "bars",
    "percents", "stars", "dollars", "ands", "hashes", "stops", "commas"]


def with_statistics(rows: DataFrame, text_col: str) -> DataFrame:
    """``rows`` with one column per statistic, named in :data:`NAMES`."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return rows.withColumns(statistics(text))


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, "<=" or ">", threshold)."""

    terms: tuple[tuple[str, str, float], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for name, op, at in self.terms:
            out = out & (F.col(name) <= at if op == "<=" else F.col(name) > at)
        return out


@dataclass
class Ensemble:
    rules: list[tuple[Rule, float]]
    intercept: float

    def score(self) -> Column:
        logit = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            logit = logit + F.when(rule.column(), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-logit))


def tree_rules(description: str, names: list[str]) -> list[Rule]:
    """The paths from the root to every node of the trees that ``toDebugString`` describes."""
    found, path = {}, []
    for line in description.splitlines():
        m = re.match(r"\s*(If|Else) \(feature (\d+) (<=|>) ([^)]+)\)", line)
        if not m:
            if line.lstrip().startswith("Tree"):
                path = []
            continue
        depth = len(line) - len(line.lstrip())
        path = [p for p in path if p[0] < depth] + [(depth, (names[int(m[2])], m[3], float(m[4])))]
        found[tuple(t for _, t in path)] = None
    return [Rule(terms) for terms in found]


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = SAMPLE,
        id_col: str = "doc_id", text_col: str = "text", seed: int = 3) -> Ensemble:
    """Fit on at most ``per_class`` labelled rows of each class that aren't held out, chosen by hash of the id.

    With one class only, its constant; without labels, an ensemble that scores 0.5.
    """
    known = (labels.select(F.col(id_col).cast("long").alias("i"), F.col(label).cast("int").alias("y"))
             .filter("y in (0, 1) and i is not null").filter(~held_out("i")))
    parts = [known.filter(F.col("y") == v).orderBy(F.xxhash64("i"), "i").limit(per_class) for v in (0, 1)]
    total = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = parts[0].unionByName(parts[1]).groupBy("i").agg(F.max("y").alias("y"))
    texts = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).join(F.broadcast(chosen), "i")
    rows = save(with_statistics(texts, "t").select(F.col("y").cast("double").alias("label"), *NAMES), "statistics")
    seen = {int(r["label"]): r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(seen) < 2:
        return Ensemble([], {(): 0.0, (0,): -4.0, (1,): 4.0}[tuple(seen)])
    # The sample holds the classes in other shares than the labels do.
    weight = F.when(F.col("label") == 1, total[1] / seen[1]).otherwise(total[0] / seen[0])
    data = VectorAssembler(inputCols=NAMES, outputCol="stats").transform(rows.withColumn("w", weight)).coalesce(4).persist()
    forest = RandomForestClassifier(featuresCol="stats", weightCol="w", numTrees=TREES, maxDepth=DEPTH, maxBins=64,
                                    featureSubsetStrategy="onethird", seed=seed).fit(data)
    rules = tree_rules(forest.toDebugString, NAMES)
    marks = [f"r{k}" for k in range(len(rules))]
    ruled = data.select("label", "w", *[r.column().cast("double").alias(m) for r, m in zip(rules, marks, strict=True)])
    ready = VectorAssembler(inputCols=marks, outputCol="rules").transform(ruled).select("label", "w", "rules").persist()
    lasso = LogisticRegression(featuresCol="rules", weightCol="w", regParam=L1, elasticNetParam=1.0,
                               standardization=False, maxIter=60).fit(ready)
    data.unpersist()
    ready.unpersist()
    return Ensemble([(r, float(c)) for r, c in zip(rules, lasso.coefficients.toArray(), strict=True) if c], float(lasso.intercept))


def quality(docs: DataFrame, ensemble: Ensemble, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Statistics read the whole text; null counts as empty, whose statistics are
    0 or 1 by definition. Null ids are kept and count as not held out;
    repeated rows score alike; other columns are ignored; an empty table gives
    an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("_text"))
    scored = with_statistics(rows, "_text").select("doc_id", "held_out", ensemble.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
