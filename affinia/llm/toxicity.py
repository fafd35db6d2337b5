"""Toxicity: non-negative positive-unlabelled learning of a linear model over words.

Only confirmed toxic texts are taken as examples of a class; everything else is unlabelled. With
class prior p, the risk of a score f under the logistic loss l is estimated as
``p E_pos[l(f)] + max(0, E_unl[l(-f)] - p E_pos[l(-f)])``: the second part stands for the unseen
negatives and cannot be negative; where it would be, the step goes the other way, which keeps a
flexible model from explaining every unlabelled text away. The prior is the toxic share of all
training labels, counted over all of them.

Features are the distinct words of the whole text, their beginnings (of each length of ``PREFIXES``
bytes, for words that are derived from a common stem), and the beginnings of two or more different
words: one word may quote or resemble an insult, several of one stem rarely do. The model is fitted in numpy to the ``POSITIVE``
confirmed and the ``UNLABELLED`` other texts of smallest hash. Their features are counted in Spark:
those in fewer than ``LEAST`` of the texts have no weight, nor those beyond the ``MOST`` frequent, so
that the driver gets numbers of a bounded vocabulary, however long the texts. A lasso step removes
features without evidence. The weights go to the tasks as one table of bounded size.

``PREFIXES`` and ``LASSO`` were chosen once by three folds of training rows alone (crc32 mod 3 not 1)
of a small table; held-out rows took no part in any choice.

Defined cases: null texts are empty and score as a text without known words; labels without doc_id
or mark are left out; repeated rows are examples of their own and are answered row by row; without
a confirmed example every score is the prior, 0 without labels; empty tables give empty results;
other columns are carried or ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinia.llm.common import annotate, plain_words, stage, thinned
from affinia.llm.quality import held_out
from affinia.llm.trees import sigmoid

POSITIVE = 3_000
UNLABELLED = 6_000
LEAST = 8
MOST = 200_000
STEPS = 300
LASSO = 4e-4
PREFIXES = (4, 6)
THRESHOLD = 0.7


def features(text: str | None) -> set[bytes]:
    words = set(plain_words(text))
    found = set(words)
    for length in PREFIXES:
        begun = Counter(w[:length] for w in words if len(w) > length)
        found |= {w + b"*" for w in begun} | {w + b"**" for w, n in begun.items() if n > 1}
    return found


class Model:
    """score = logistic(base + the weights of the text's features)."""

    def __init__(self, base: float, weights: dict[bytes, float]):
        self.base, self.weights = base, weights


def score(base: float, weights: dict[bytes, float], text: str | None) -> float:
    known = weights.keys() & features(text)
    # In one order, so that equal texts have equal scores.
    total = base + sum(weights[w] for w in sorted(known))
    return float(sigmoid(np.float64(total)))


def risk(
    f: np.ndarray, n_pos: int, prior: float
) -> tuple[float, float, np.ndarray]:
    """The part of the risk from confirmed texts, that of the unseen negatives (before it is cut off
    at 0), and the slope in the scores ``f`` (the first ``n_pos`` are confirmed) that a step follows."""
    n_unl = len(f) - n_pos
    p = sigmoid(f)
    soft = np.logaddexp(0, f)
    positive = prior * np.logaddexp(0, -f[:n_pos]).mean()
    negative = soft[n_pos:].mean() - prior * soft[:n_pos].mean()
    is_pos = np.arange(len(f)) < n_pos
    as_positive = np.where(is_pos, prior * (p - 1) / n_pos, 0.0)
    as_negative = np.where(is_pos, -prior * p / n_pos, p / n_unl)
    return positive, negative, as_positive + as_negative if negative >= 0 else -as_negative


def fit(
    rows: list[np.ndarray], n_pos: int, names: list[bytes], prior: float, lasso: float = LASSO,
    steps: int = STEPS,
) -> Model:
    """From the numbers of each text's features, the ``n_pos`` confirmed texts first."""
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    base = float(np.log(prior / (1 - prior)))
    n = len(rows)
    if not n_pos or n == n_pos:
        return Model(base, {})
    row = np.repeat(np.arange(n, dtype=np.int32), [len(r) for r in rows])
    column = np.concatenate(rows)
    weight, bias = np.zeros(len(names)), base
    m, v = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for step in range(1, steps + 1):
        _, _, slope = risk(bias + np.bincount(row, weight[column], n), n_pos, prior)
        gradient = np.append(np.bincount(column, slope[row], len(names)), slope.sum())
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        rate = 0.05 * (1 - step / (steps + 1)) ** 0.5
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        weight -= move[:-1]
        bias -= move[-1]
        shrink = lasso / (np.sqrt(v[:-1] / (1 - 0.999**step)) + 1e-8) * rate
        weight = np.sign(weight) * np.maximum(0, np.abs(weight) - shrink)
    return Model(float(bias), {names[i]: float(weight[i]) for i in np.flatnonzero(weight)})


def vocabulary(texts: list[set[bytes]], least: int = LEAST, most: int = MOST) -> list[bytes]:
    """The features of at least ``least`` texts, of these the ``most`` frequent, in order."""
    seen = Counter()
    for found in texts:
        seen.update(found)
    often = sorted((-n, w) for w, n in seen.items() if n >= least)[:most]
    return sorted(w for _, w in often)


def train(
    docs: DataFrame, labels: DataFrame, positive: int = POSITIVE, unlabelled: int = UNLABELLED
) -> Model:
    """Learns ``labels.toxic`` from rows whose crc32(doc_id) mod 3 is not 1."""
    known = labels.where(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"), 3, 1)
    )
    total, toxic = known.agg(F.count("*"), F.count(F.when(F.col("toxic") == 1, 1))).first()
    if not toxic:
        return Model(-1e3 if not total else float(np.log(1e-6)), {})
    order = F.xxhash64("doc_id", F.lit(3))
    # Both samples are bounded by their parameters, and so is what is broadcast or collected.
    marked = known.where("toxic = 1").select("doc_id").distinct()
    chosen = F.broadcast(
        thinned(marked, order, marked.count(), positive).orderBy(order, "doc_id").limit(positive)
    )
    texts = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    others = texts.where(~held_out(F.col("doc_id"), 3, 1)).select("doc_id")
    other = F.xxhash64("doc_id", F.lit(5))
    picked = thinned(others, other, others.count(), unlabelled).orderBy(other, "doc_id").limit(unlabelled).distinct()

    def distinct(values: list) -> list[dict]:
        return [{"words": sorted(features(t))} for t in values]

    kind = T.StructType([T.StructField("words", T.ArrayType(T.BinaryType()))])

    def words_of(sample: DataFrame, most: int, part: int) -> DataFrame:
        mine = texts.join(F.broadcast(sample), "doc_id", "left_semi")
        rows = annotate(mine, distinct, kind, carry=["doc_id"]).select("row.doc_id", "result.words")
        rows = rows.orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id", "words").limit(most)
        return rows.select(F.lit(part).alias("part"), F.monotonically_increasing_id().alias("at"), "words")

    sample = stage(words_of(chosen, positive, 0).union(words_of(picked, unlabelled, 1)), "sample")
    each = sample.select("part", "at", F.explode("words").alias("word"))
    often = each.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST)
    names = sorted(bytes(r.word) for r in often.orderBy(F.desc("n"), "word").limit(MOST).collect())
    numbers = docs.sparkSession.createDataFrame(
        list(zip(names, range(len(names)))), "word binary, number int"
    )
    # Texts without a known feature count as well, so the numbers are joined to the sample.
    kept = each.join(F.broadcast(numbers), "word").groupBy("part", "at").agg(
        F.sort_array(F.collect_list("number")).alias("numbers")
    )
    held = sample.select("part", "at").join(kept, ["part", "at"], "left").orderBy("part", "at").toArrow()
    rows = [np.array(r or [], np.int32) for r in held.column("numbers").to_pylist()]
    n_pos = held.column("part").to_pylist().count(0)
    return fit(rows, n_pos, names, toxic / total)


def scored(docs: DataFrame, model: Model, carry: list[str] | None = None) -> DataFrame:
    """``row`` (the carried columns) and ``result.score``."""
    held = docs.sparkSession.sparkContext.broadcast((model.base, model.weights))

    def fn(texts: list) -> list[dict]:
        base, weights = held.value
        return [{"score": score(base, weights, t)} for t in texts]

    return annotate(docs, fn, T.StructType([T.StructField("score", T.DoubleType())]), carry)
