"""Text quality by a sparse ensemble of rules compiled to Spark columns.

1. *Statistics.* One pass over the texts gives about thirty numbers per document
   (shares of character classes, word and line statistics), written once as a
   narrow table. Nothing but the text enters them.
2. *Rules.* A random forest of shallow trees is grown on all labelled training
   rows with Spark's library. Every path from a root is a rule: a conjunction of
   comparisons of statistics.
3. *Lasso.* A logistic regression with an L1 penalty over the rules' truth
   values keeps few of them.
4. *Score.* The kept rules and weights become one Spark expression over the
   statistics' columns, so scoring is a projection without Python.

Nulls and edges: a null text is an empty one, whose statistics are all 0; a null
id is kept and never used for training; repeated rows are scored each; label
rows with a null label or id are left out, repeated labels count as they stand;
without labels of both classes every score is the share of good labels (0.5
without any); an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, stored, text_or_empty

CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789",
    "blank": b" \t\r\n\x0b\x0c", "newline": b"\n", "stop": b".!?", "comma": b",;:", "exclaim": b"!",
    "symbol": b"#$%&*+<=>@\\^_`|~", "bracket": b"()[]{}", "quote": b"\"'", "slash": b"/", "dash": b"-",
}
STATISTICS = ("log_bytes", *CLASSES, "wide", "word_length", "word_spread", "long_words", "distinct_words", "top_word",
              "capital_words", "symbol_words", "lines", "line_length", "repeated_lines", "short_lines", "closed_lines",
              "words_per_stop")


def _class_table() -> np.ndarray:
    table = np.zeros((256, len(CLASSES) + 1))
    for i, members in enumerate(CLASSES.values()):
        table[list(members), i] = 1
    table[128:, -1] = 1
    return table


def statistics(text: str, table: np.ndarray) -> list[float]:
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return [0.0] * len(STATISTICS)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    shares = counts @ table / len(data)
    n = len(words)
    lengths = np.fromiter(map(len, words), np.float64, n)
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    ends = np.frombuffer(b"".join([w[-1:] for w in words]), np.uint8)
    starts = np.frombuffer(b"".join([w[:1] for w in words]), np.uint8)
    names = list(CLASSES)
    lines = [x for x in data.split(b"\n") if x.strip()]
    k = len(lines)
    return [float(np.log1p(len(data))), *shares.tolist(), lengths.mean(), lengths.std(), (lengths > 20).mean(),
            len(seen) / n, max(seen.values()) / n, table[starts, names.index("upper")].mean(),
            table[ends, names.index("symbol")].mean(), float(np.log1p(k)), len(data) / k, 1 - len(set(lines)) / k,
            sum(len(x) < 40 for x in lines) / k, sum(x.rstrip()[-1:] in (b".", b"!", b"?") for x in lines) / k,
            n / (1 + counts[list(CLASSES["stop"])].sum())]


def text_statistics(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", key_col: str | None = None) -> DataFrame:
    """(doc_id, one double column per statistic) per row; with ``key_col``, a string column carried along as ``key``."""
    table = _class_table()
    kept = ["doc_id", "key"] if key_col else ["doc_id"]

    def make(batches):
        for batch in batches:
            x = np.array([statistics(t, table) for t in batch.column("text").to_pylist()]).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *[pa.array(c, pa.float64()) for c in x.T]],
                                             names=[*kept, *STATISTICS])

    rows = pick(docs, doc_id=id_col, text=text_col, **({"key": key_col} if key_col else {}))
    rows = rows.withColumns({"doc_id": F.col("doc_id").cast("long"), "text": text_or_empty()})
    return rows.mapInArrow(make, "doc_id long, " + ("key string, " if key_col else "") + ", ".join(f"{s} double" for s in STATISTICS))


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    threshold: float

    def column(self) -> Column:
        c = F.col(self.statistic)
        return c > self.threshold if self.above else c <= self.threshold


Rule = frozenset  # of Conditions, all of which must hold


def simplified(path: list[Condition]) -> Rule:
    """A path's tightest condition per statistic and direction."""
    tight: dict[tuple[str, bool], float] = {}
    for c in path:
        key = (c.statistic, c.above)
        tight[key] = c.threshold if key not in tight else (max if c.above else min)(tight[key], c.threshold)
    return frozenset(Condition(s, above, t) for (s, above), t in tight.items())


def tree_rules(model) -> list[Rule]:
    """Every path of every tree of a fitted forest, without repeats, in a fixed order."""
    rules: dict[Rule, None] = {}
    for tree in model.trees:
        todo = [(tree._java_obj.rootNode(), [])]
        while todo:
            node, path = todo.pop()
            if path:
                rules.setdefault(simplified(path))
            if node.subtreeDepth() > 0:
                split = node.split()
                name, at = STATISTICS[split.featureIndex()], float(split.threshold())
                todo += [(node.leftChild(), [*path, Condition(name, False, at)]),
                         (node.rightChild(), [*path, Condition(name, True, at)])]
    return list(rules)


def rule_column(rule: Rule) -> Column:
    conditions = sorted(rule, key=lambda c: (c.statistic, c.above))
    return reduce(lambda a, b: a & b, [c.column() for c in conditions])


@dataclass(frozen=True)
class Ensemble:
    intercept: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.weights:
            total = total + F.when(rule_column(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit_ensemble(rows: DataFrame, *, trees: int = 20, depth: int = 3, penalty: float = 0.002, seed: int = 5) -> Ensemble:
    """Rules and weights from labelled statistics (column ``y``: 0.0 or 1.0, both present)."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    assembled = VectorAssembler(inputCols=list(STATISTICS), outputCol="x").transform(rows).select("x", "y")
    forest = RandomForestClassifier(featuresCol="x", labelCol="y", numTrees=trees, maxDepth=depth, seed=seed,
                                    subsamplingRate=0.5, featureSubsetStrategy="onethird").fit(assembled)
    rules = tree_rules(forest)
    if not rules:
        share = min(max(rows.agg(F.avg("y")).first()[0], 1e-6), 1 - 1e-6)
        return Ensemble(float(np.log(share / (1 - share))), ())
    truth = rows.select("y", *[rule_column(r).cast("double").alias(f"r{i}") for i, r in enumerate(rules)])
    truth = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="x").transform(truth).select("x", "y")
    lasso = LogisticRegression(featuresCol="x", labelCol="y", elasticNetParam=1.0, regParam=penalty, maxIter=60,
                               standardization=False, family="binomial").fit(truth)
    weights = lasso.coefficients.toArray()
    kept = tuple((r, float(w)) for r, w in zip(rules, weights) if w)
    return Ensemble(float(lasso.intercept), kept)


def score_quality(docs: DataFrame, labels: DataFrame, *, train: Column, id_col: str = "doc_id", text_col: str = "text",
                  label_id: str = "doc_id", label_col: str = "quality", key_col: str | None = None, **fit) -> DataFrame:
    """(doc_id, score) per row. ``train`` is a condition on ``doc_id``: labels of other rows are not looked at.

    With ``key_col``, a string column carried along as ``key``.
    """
    stats = stored(text_statistics(docs, id_col=id_col, text_col=text_col, key_col=key_col), "statistics")
    known = (pick(labels, doc_id=label_id, y=label_col).select(F.col("doc_id").cast("long").alias("doc_id"),
                                                               F.col("y").cast("double").alias("y"))
             .filter(F.col("doc_id").isNotNull() & F.col("y").isin(0.0, 1.0) & train))
    rows = stored(stats.join(known, "doc_id").select("y", *STATISTICS), "labelled-statistics")
    least, most = rows.agg(F.min("y"), F.max("y")).first()
    kept = ["doc_id", "key"] if key_col else ["doc_id"]
    if least == most:
        return stats.select(*kept, F.lit(0.5 if least is None else float(least)).alias("score"))
    return stats.select(*kept, fit_ensemble(rows, **fit).score().alias("score"))
