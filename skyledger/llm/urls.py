"""URL filters: longest-match host and path rules, else logistic regression on hashed character n-grams.

Everything is built-in Spark: parsing and rules are SQL expressions, n-grams a
regular expression, the classifier Spark ML's. The classifier learns from a
small labelled table of URLs, by default a bounded sample judged by the rules.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm import text as tx
from skyledger.llm.store import save

#: Verdict, host, path.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
BUCKETS = 1 << 12
SAMPLE = 2_000   # labelled URLs of each class at most


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (its text) and its verdict; null where none does."""
    text = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text, verdict = F.when(fits, h + p).otherwise(text), F.when(fits, v).otherwise(verdict)
    return text, verdict


def grams(host: Column, path: Column) -> Column:
    """Character 3- and 4-grams of ``^host$`` and ``^path$``, marked by part."""
    def of(part: Column, mark: str, n: int) -> Column:
        whole = F.concat(F.lit("^"), part, F.lit("$"))
        return F.transform(F.regexp_extract_all(whole, F.lit(f"(?s)(?=({'.' * n}))"), F.lit(1)), lambda g: F.concat(F.lit(mark), g))
    return F.concat(*[of(part, mark, n) for part, mark in ((host, "h:"), (path, "p:")) for n in (3, 4)])


def _hashed(rows: DataFrame) -> DataFrame:
    return HashingTF(numFeatures=BUCKETS, inputCol="grams", outputCol="features", binary=True).transform(rows)


def fit(labelled: DataFrame, url_col: str = "url", label_col: str = "blocked", per_class: int = SAMPLE) -> LogisticRegressionModel | None:
    """Fit on at most ``per_class`` URLs of each class (0 allow, 1 block), chosen by hash; None without both classes."""
    rows = labelled.select(F.col(url_col).alias("u"), F.col(label_col).cast("double").alias("label")).filter("u is not null and label in (0, 1)")
    parts = [rows.filter(F.col("label") == v).orderBy(F.xxhash64("u"), "u").limit(per_class) for v in (0.0, 1.0)]
    chosen = save(parts[0].unionByName(parts[1]), "urls")
    if chosen.select("label").distinct().count() < 2:
        return None
    ready = _hashed(chosen.select("label", grams(host_of(F.col("u")), path_of(F.col("u"))).alias("grams")))
    data = ready.coalesce(2).persist()
    model = LogisticRegression(maxIter=30, regParam=0.01).fit(data)
    data.unpersist()
    return model


def judge(pages: DataFrame, model: LogisticRegressionModel | None, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """One row per row of ``pages``: ``page_id, host, path, rule, verdict, p_block``.

    A rule fits its host and all subdomains if the path starts with the rule's;
    the longest wins. Elsewhere the classifier blocks from 0.5 on. Null URLs
    and URLs without ``://`` have empty host and path, and like any other are
    judged by the classifier (allowed if there is none). Null ids are kept,
    repeated rows give repeated rows, other columns are ignored; an empty
    table gives an empty result.
    """
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("rule"), said.alias("said"))
    if model is None:
        p = F.lit(0.0)
    else:
        rows = model.transform(_hashed(rows.withColumn("grams", grams(F.col("host"), F.col("path")))))
        p = vector_to_array("probability")[1]
    return rows.select("page_id", "host", "path", "rule",
                       F.coalesce("said", F.when(p >= 0.5, "block").otherwise("allow")).alias("verdict"), p.alias("p_block"))


def rule_labels(pages: DataFrame, url_col: str = "url", rules=RULES) -> DataFrame:
    """``url, blocked`` for the URLs that a rule judges: the labelled table where none is given."""
    url = F.col(url_col)
    _, said = rule_of(host_of(url), path_of(url), rules)
    return pages.select(url.alias("url"), said.alias("said")).filter("said is not null").select(
        "url", (F.col("said") == "block").cast("double").alias("blocked"))
