"""Quality classifier: a sparse rule ensemble over text statistics.

Every root-to-node path of a small random forest becomes a conjunctive rule over the statistics; a lasso
logistic regression weighs the rules and drops most; the ones left are compiled into one Spark column
expression. Statistics, rules and score run as column expressions over whole texts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arbiter.llm.common import WHITE, WORD, stage, work_path

#: Labelled rows the model is fitted on, at most in expectation (chosen by a hash of the id).
FIT_ROWS = 20_000
SYMBOLS = "#*$%&|<>"


def text_statistics(text: Column) -> dict[str, Column]:
    """Statistics of a non-null text; every one is 0 where it is undefined (no words, no lines)."""
    words = F.regexp_extract_all(text, F.lit(WORD), 0)
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.btrim(x, F.lit(WHITE))) > 0)
    count = lambda chars: F.regexp_count(text, F.lit(f"[{chars}]"))
    n, visible = F.size(words), F.length(text) - count(r"\x20\x09-\x0D")
    per = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    return {
        "log_words": F.log1p(n),
        "word_length": per(visible, n),
        "symbols": per(count(SYMBOLS), visible),
        "exclaims": per(count("!?"), visible),
        "stops": per(count(".,;:"), visible),
        "digits": per(count("0-9"), visible),
        "capitals": per(count(r"\p{Lu}"), visible),
        "distinct_words": per(F.size(F.array_distinct(words)), n),
        "line_words": per(n, F.size(lines)),
        "repeated_lines": per(F.size(lines) - F.size(F.array_distinct(lines)), F.size(lines)),
        "closed_lines": per(F.size(F.filter(lines, lambda x: x.rlike(r"[.!?]\s*$"))), F.size(lines)),
    }


@dataclass(frozen=True)
class Rule:
    """A conjunction: (statistic, whether above, threshold), sorted, one per statistic and side."""
    tests: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for name, above, at in self.tests:
            out = out & (F.col(name) > at if above else F.col(name) <= at)
        return out

    def __str__(self) -> str:
        return " and ".join(f"{n} {'>' if above else '<='} {at:.4g}" for n, above, at in self.tests)


def tree_rules(forest, names: list[str], spark) -> list[Rule]:
    """The distinct paths of a fitted forest; the node table is as small as trees x 2^depth."""
    path = work_path(spark, "forest")
    forest.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()
    by_tree: dict[int, dict[int, object]] = {}
    for r in nodes:
        by_tree.setdefault(r["treeID"], {})[r["id"]] = r
    found: dict[Rule, None] = {}
    for _, tree in sorted(by_tree.items()):
        todo = [(0, {})]
        while todo:
            at, tests = todo.pop()
            if tests:
                found[Rule(tuple(sorted((n, above, x) for (n, above), x in tests.items())))] = None
            node = tree[at]
            if node["leftChild"] < 0:
                continue
            name, x = names[node["split"]["featureIndex"]], node["split"]["leftCategoriesOrThreshold"][0]
            low, high = dict(tests), dict(tests)
            low[name, False] = min(x, low.get((name, False), x))
            high[name, True] = max(x, high.get((name, True), x))
            todo += [(node["leftChild"], low), (node["rightChild"], high)]
    return list(found)


@dataclass(frozen=True)
class RuleEnsemble:
    """Weighted rules; ``score`` is the logistic of their sum."""
    bias: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        total = F.lit(self.bias)
        for rule, weight in self.weights:
            total = total + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit_rules(sample: DataFrame, names: list[str], trees: int = 20, depth: int = 4, lasso: float = 0.001,
              seed: int = 42) -> RuleEnsemble:
    """``sample``: label (0/1) and the statistics. Without both labels the score is the constant base rate
    (one half without any row)."""
    import math
    spark = sample.sparkSession
    good, rows = sample.agg(F.sum("label"), F.count("*")).first()
    if not rows or good in (0, rows):
        share = (float(good or 0) + 0.5) / (rows + 1)
        return RuleEnsemble(math.log(share / (1 - share)), ())
    data = sample.select(F.col("label").cast("double").alias("label"), *names,
                         array_to_vector(F.array(*[F.col(n).cast("double") for n in names])).alias("features"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, minInstancesPerNode=10).fit(data)
    rules = tree_rules(forest, names, spark)
    if not rules:
        return RuleEnsemble(math.log(good / (rows - good)), ())
    holds = stage(data.select("label", array_to_vector(F.array(*[r.column().cast("double") for r in rules])).alias("features")),
                  "rule-rows")
    fitted = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=100, standardization=False).fit(holds)
    kept = [(r, float(w)) for r, w in zip(rules, fitted.coefficients.toArray(), strict=True) if abs(w) > 1e-9]
    return RuleEnsemble(float(fitted.intercept), tuple(kept))


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", fit_rows: int = FIT_ROWS, fold: Callable[[Column], Column] | None = None,
                  cut: float = 0.3) -> DataFrame:
    """One row per input row: ``id_col``, held_out, score, predicted.

    ``fold`` maps the id column to "held out"; by default crc32 of the id as text is divisible by 5. Only
    labelled rows outside it are learnt from: about ``fit_rows`` of them, taken by a hash of the id (all,
    when there are fewer). Null and empty texts have statistics 0 and a score like any other; a null id is not held out
    and not learnt from. Rows with several labels count once for each, null labels not at all. Rows
    repeat as they came; an empty table gives no rows. Only id and text of ``docs`` are looked at.
    """
    fold = fold or (lambda c: F.crc32(c.cast("string").cast("binary")) % 5 == 0)
    text = F.col("_text")
    base = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    made = text_statistics(text)
    names = list(made)
    rows = stage(base.select("_id", F.coalesce(fold(F.col("_id")), F.lit(False)).alias("held_out"),
                             *[c.cast("double").alias(n) for n, c in made.items()]), "statistics")
    known = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label"))
             .filter(F.col("label").isin(0, 1) & F.col("_id").isNotNull() & ~fold(F.col("_id"))))
    n = known.count()
    share = min(1.0, fit_rows / n) if n else 1.0
    chosen = known.filter((F.xxhash64("_id", F.lit("fit")).cast("double") / 2.0 ** 64 + 0.5) < share)
    sample = stage(rows.join(chosen.hint("merge"), "_id"), "statistics-sample")
    model = fit_rules(sample, names)
    score = model.score()
    return rows.select(F.col("_id").alias(id_col), "held_out", score.alias("score"),
                       (score >= cut).cast("int").alias("predicted"))
