"""Quality classifier: a sparse ensemble of rules, compiled into Spark column expressions.

Statistics of the whole text are Spark columns. Boosted trees are fitted to the statistics of a
bounded sample of labelled rows; every path of a tree is a rule (a conjunction of comparisons); a
lasso-penalised logistic regression keeps few of the rules; the score is an expression of them, so
scoring a document needs no Python.

The sample is the ``SAMPLE`` labelled rows of smallest hash, drawn from all of them, and is the
same at every run. Defined cases: null texts are empty texts and get a score; labels without a
doc_id or a mark are left out; repeated labels or documents are examples of their own; without
examples of both classes every score is the share of good examples, or 0.5 without any; empty
tables give empty results; other columns are carried or ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.llm import trees
from affinia.llm.common import packed, thinned

SAMPLE = 20_000
PENALTY = 0.0005
THRESHOLD = 0.7


def held_out(doc_id: Column, modulus: int, rest: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == rest, F.lit(False))


def _rest(text: Column, pattern: str) -> Column:
    """How many characters of ``text`` match a character class."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def statistics(text: Column) -> dict[str, Column]:
    """Numbers from the whole text, each a double."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    words = F.filter(F.split(text, r"[ \t\n\r]+"), lambda w: w != "")
    lines = F.split(text, "\n")
    chars = F.greatest(F.length(text), F.lit(1))
    n_words = F.greatest(F.size(words), F.lit(1))
    found = {
        "chars": F.length(text),
        "words": F.size(words),
        "word_length": F.length(text) / n_words,
        "distinct_words": F.size(F.array_distinct(words)) / n_words,
        "distinct_lines": F.size(F.array_distinct(lines)) / F.size(lines),
        "line_length": F.length(text) / F.size(lines),
        "upper": _rest(text, r"\p{Lu}+") / chars,
        "digits": _rest(text, r"[0-9]+") / chars,
        "symbols": _rest(text, r"[^\p{L}\p{M}\p{N}\s.,;:'\"?()-]+") / chars,
        "stops": _rest(text, r"[.?!]+") / chars,
        "commas": _rest(text, r"[,;:]+") / chars,
    }
    return {name: column.cast("double") for name, column in found.items()}


@dataclass
class RuleModel:
    """score = logistic(base + sum of weight over the rules that hold)."""

    base: float
    rules: list[tuple[float, tuple]]  # (weight, ((statistic, is_at_most, threshold), ...))

    def score(self, columns: dict[str, Column]) -> Column:
        total = F.lit(self.base)
        for weight, rule in self.rules:
            holds = F.lit(True)
            for name, at_most, threshold in rule:
                holds = holds & (columns[name] <= threshold if at_most else columns[name] > threshold)
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit_rules(x: np.ndarray, y: np.ndarray, names: list[str], penalty: float = PENALTY) -> RuleModel:
    """Rules from the paths of boosted trees, weighted by a lasso logistic regression."""
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    constant = RuleModel(float(np.log(share / (1 - share))), [])
    if len(np.unique(y)) < 2:
        return constant
    model = trees.fit_boosted(x, y, rounds=40, depth=3, rate=0.2, least=max(5, len(y) // 400), share=0.6)
    rules = list(dict.fromkeys(p for tree in model.trees for p in trees.paths(tree)))
    held = np.stack([_holds(x, rule) for rule in rules], axis=1) if rules else np.zeros((len(y), 0))
    _, first = np.unique(held, axis=1, return_index=True)  # rules that hold on the same rows
    first = [k for k in np.sort(first) if 0 < held[:, k].mean() < 1]
    rules, held = [rules[k] for k in first], held[:, first]
    base, weights = lasso_logistic(held.astype(np.float64), y, penalty)
    kept = [(float(w), tuple((names[f], m, t) for f, m, t in rule)) for w, rule in zip(weights, rules) if w]
    return RuleModel(float(base), kept)


def _holds(x: np.ndarray, rule: tuple) -> np.ndarray:
    out = np.ones(len(x), bool)
    for f, at_most, threshold in rule:
        out &= x[:, f] <= threshold if at_most else x[:, f] > threshold
    return out


def lasso_logistic(x: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """Mean logistic loss plus penalty * |weights| by accelerated proximal gradient steps."""
    n = len(y)
    ones = np.column_stack([np.ones(n), x])
    gram = ones.T @ ones / n
    step = 4.0 / max(1e-9, float(np.linalg.eigvalsh(gram)[-1]))
    w = z = np.zeros(ones.shape[1])
    t = 1.0
    for _ in range(steps):
        new = z - step * (ones.T @ (trees.sigmoid(ones @ z) - y)) / n
        new[1:] = np.sign(new[1:]) * np.maximum(0, np.abs(new[1:]) - step * penalty)
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        z = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return float(w[0]), w[1:]


def labelled_sample(labels: DataFrame, mark: str, modulus: int, rest: int, rows: int) -> DataFrame:
    """doc_id, y of the training labels of smallest hash, at most ``rows`` of them."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(mark).isin(0, 1))
        .where(~held_out(F.col("doc_id"), modulus, rest))
        .select("doc_id", F.col(mark).cast("double").alias("y"))
    )
    key = F.xxhash64("doc_id", F.lit(modulus))
    return thinned(known, key, known.count(), rows).orderBy(key, "doc_id", "y").limit(rows)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> RuleModel:
    """Learns ``labels.quality`` from rows whose crc32(doc_id) mod 4 is not 2."""
    # At most `sample` pairs of numbers, so the broadcast is bounded.
    chosen = F.broadcast(labelled_sample(labels, "quality", 4, 2, sample))
    columns = statistics(F.col("text"))
    rows = (
        docs.select("doc_id", "text").join(chosen, "doc_id")
        .select("doc_id", "y", *[c.alias(n) for n, c in columns.items()])
        .orderBy(F.xxhash64("doc_id"), "doc_id", "y", *columns).limit(sample).toPandas()
    )
    names = list(columns)
    if not len(rows):
        return RuleModel(0.0, [])
    return fit_rules(rows[names].to_numpy(float), rows["y"].to_numpy(float), names)


def scored(docs: DataFrame, model: RuleModel, carry: list[str] | None = None) -> DataFrame:
    """``row`` (the carried columns) and ``score``."""
    carry = docs.columns if carry is None else carry
    columns = statistics(F.col("text"))
    used = {name for _, rule in model.rules for name, _, _ in rule}
    stats = docs.select(
        packed(carry).alias("row"),
        F.struct(F.lit(0).alias("none"), *[c.alias(n) for n, c in columns.items() if n in used]).alias("s"),
    )
    return stats.select("row", model.score({n: F.col(f"s.{n}") for n in used}).alias("score"))


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts; all of them if it learnt nothing."""
    model = train(docs, labels, sample)
    if not model.rules:
        return docs
    return scored(docs, model).where(F.col("score") >= THRESHOLD).select("row.*")
