"""Mixing to target weights by soft membership, in DataFrame functions only.

A softmax classifier is fitted on a bounded sample of the labelled table; it gives every document a posterior over domains. Its features
are the shares of hashed stems (first letters of each word) and of shapes of the blank-separated tokens (runs of capitals, small letters
and digits as one sign each, other characters as they are). Only features whose document frequency in some domain differs by
`ASSOCIATION` standard deviations from chance have weights. The weights are trained in the driver, on the bounded sample; the
epoch with the least log loss on a fifth of the rows, held back, counts, so that posteriors are neither too sure nor too faint.

Rates x >= 0 minimise the squared distance between expected domain tokens, A x with A = tokens * posterior, and the targets, by lazily
projected gradient (dual averaging): the steps against the gradient add up in k multipliers m, and the rates are the projection of the
start after all of them, x = max(0, 1 - p . m). A weight of `PULL` on the distance from 1 makes the solution unique, also where no
rates meet the targets. A round is one aggregate of a few numbers, at several multipliers: after the safe step (the Lipschitz
constant, at most all tokens, bounds it), and after steps scaled by the Gram matrix of the documents that can move. The best of them
counts, so every round gains at least as much as the safe step. Rounds end when the gradient is below the tolerance or nothing is
gained in double precision; their count has no bound. copies() turns rates into whole copies, by a hash of the key.

Defined cases: null, empty or wordless texts have no tokens, the prior as posterior, and a rate like others of that posterior.
Null keys and repeated rows are documents like any other. Labels that are null, name no document or contradict each other each
count as they stand (null ones teach nothing). Without any label every domain gets an equal posterior; an empty table gives an
empty result. Targets that no rates can meet give the rates that come nearest in the least squares. Only key and text are read;
outputs carry the key and the columns named here.
"""

from __future__ import annotations

import json
import logging
import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, materialise

log = logging.getLogger(__name__)
STEMS, SHAPES = 1 << 16, 1 << 10  # hashed features of either kind
STEM = 6  # letters
FEATURES = STEMS + SHAPES
ASSOCIATION = 3.0  # standard deviations
PULL = 1e-7  # of the rates toward 1, against the squared distance in shares of all tokens
DAMPING = (1.0, 0.3, 0.1, 0.03, 0.01)


@dataclass(frozen=True)
class Classifier:
    bias: list[float]  # by domain
    weights: list[list[float]]  # of every feature's share, by domain


@dataclass(frozen=True)
class Mix:
    """The multipliers, and how near their rates come: `residual` is the largest part of the gradient, as a share of all tokens."""

    multipliers: list[float]
    targets: list[float]
    reached: list[float]
    residual: float
    rounds: int


def _items(text: Column) -> tuple[Column, Column]:
    """(words, shapes) of a text."""
    signs = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), r"\p{Lu}+", "A"), r"[\p{Ll}\p{Lo}\p{M}]+", "a"), r"\p{N}+", "0")
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+"), "")
    return words, F.array_remove(F.split(signs, r"\s+"), "")


def _stem(word: Column) -> Column:
    return F.pmod(F.xxhash64(F.substring(word, 1, STEM)), F.lit(STEMS)).cast("int")


def _shape(item: Column) -> Column:
    return (F.pmod(F.xxhash64(item), F.lit(SHAPES)) + STEMS).cast("int")


def _features(text: Column) -> Column:
    """Feature numbers of stems and shapes of a text."""
    words, shapes = _items(text)
    return F.concat(F.transform(words, _stem), F.transform(shapes, _shape))


def fit(docs: DataFrame, key: str, text: str, labels: DataFrame, label_key: str, domain: Column, domains: list[str], max_rows: int = 8000) -> Classifier:
    """From about max_rows labelled rows, chosen by a hash of the key; a fifth of them is held back to end the training."""
    marked = labels.select(F.col(label_key).alias("id"), domain.alias("domain")).where(F.col("domain").isin(domains))
    total = marked.count()
    share = min(1.0, max_rows / total) if total else 1.0
    place = lambda c: F.pmod(F.xxhash64(F.col(c).cast("string")), F.lit(1 << 20))
    below = math.ceil(share * (1 << 20))
    texts = docs.where(place(key) < below).select(F.col(key).alias("id"), F.col(text).alias("text"))
    held = F.coalesce(F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(3)), F.lit(5)) == 0, F.lit(False))
    sample = materialise(marked.where(place("id") < below).join(texts, "id").select("domain", _features(F.col("text")).alias("__f"), held.alias("held")), "labelled")
    kept = _associated(sample, domains)
    at = [0] * FEATURES
    for i, f in enumerate(kept, 1):
        at[f] = i
    numbers = F.from_json(F.lit(json.dumps(at)), "array<int>")
    known = F.array_join(F.array_remove(F.transform("__f", lambda f: F.get(numbers, f)), 0).cast("array<string>"), " ")
    taught = sample.select("domain", "held", F.greatest(F.size("__f"), F.lit(1)).alias("size"), known.alias("known"))
    # the bounded sample, as compact as text and numbers are
    rows = [(domains.index(r["domain"]), r["held"], r["size"], np.array(r["known"].split(), np.int32)) for r in taught.toLocalIterator()]
    discard(sample)
    bias, weights = _train(rows, len(kept), len(domains))
    out = [[0.0] * FEATURES for _ in domains]
    for d, own in enumerate(weights):
        for f, w in zip(kept, own, strict=True):
            out[d][f] = w
    return Classifier(bias, out)


def _associated(sample: DataFrame, domains: list[str]) -> list[int]:
    """Features that stand in more or fewer documents of some domain than chance would have it."""
    of = [F.sum(F.when(F.col("domain") == d, 1).otherwise(0)).alias(f"n{i}") for i, d in enumerate(domains)]
    rows = sample.agg(F.count("*").alias("all"), *of).first()
    if not rows["all"]:
        return []
    counts = sample.select("domain", F.explode(F.array_distinct("__f")).alias("feature")).groupBy("feature").agg(F.count("*").alias("n"), *of)
    shares = [rows[f"n{i}"] / rows["all"] for i in range(len(domains))]
    far = [F.abs(F.col(f"n{i}") - F.col("n") * q) >= ASSOCIATION * F.sqrt(F.col("n") * (q * (1 - q)) + 0.5) for i, q in enumerate(shares)]
    return sorted(r["feature"] for r in counts.where(F.array_contains(F.array(*far), True)).select("feature").collect())


def _train(rows: list[tuple[int, bool, int, np.ndarray]], features: int, k: int, epochs: int = 400, rate: float = 0.1, momentum: float = 0.9) -> tuple[list[float], list[list[float]]]:
    """(biases, weights by domain) of a softmax over shares of features, which are scaled by their root mean square for training."""
    y = np.array([r[0] for r in rows], np.int64)
    prior = np.log((np.bincount(y, minlength=k) + 1.0) / (len(y) + k))
    if not features:
        return prior.tolist(), [[] for _ in range(k)]
    row = np.repeat(np.arange(len(rows)), [len(r[3]) for r in rows])
    pairs, times = np.unique(row * features + np.concatenate([r[3] for r in rows]) - 1, return_counts=True)
    row, col = pairs // features, pairs % features
    value = times / np.array([r[2] for r in rows])[row]
    scale = np.sqrt(np.bincount(col, weights=value**2, minlength=features) / np.maximum(1, np.bincount(col, minlength=features)))
    value = value / scale[col]
    held = np.array([r[1] for r in rows], bool)
    teach = ~held if (~held).any() else np.ones(len(y), bool)
    target = np.eye(k)[y]
    rate /= max(1.0, float(np.bincount(row, weights=value**2, minlength=len(y)).mean()) / 10)
    b, w = prior.copy(), np.zeros((features, k))
    speed_b, speed_w = np.zeros(k), np.zeros((features, k))
    best = (math.inf, b, w)
    for _ in range(epochs):
        logits = np.stack([np.bincount(row, weights=value * w[col, d], minlength=len(y)) for d in range(k)], axis=1) + b
        odds = np.exp(logits - logits.max(axis=1, keepdims=True))
        p = odds / odds.sum(axis=1, keepdims=True)
        loss = -np.log(np.maximum(p[np.arange(len(y)), y], 1e-300))[held if held.any() else teach].mean()
        if loss < best[0]:
            best = (loss, b.copy(), w.copy())
        slope = (p - target) * teach[:, None]
        size = teach.sum() / 10  # rare domains need long steps
        speed_w = momentum * speed_w - rate * np.stack([np.bincount(col, weights=value * slope[row, d], minlength=features) for d in range(k)], axis=1) / size
        speed_b = momentum * speed_b - rate * slope.sum(axis=0) / size
        w, b = w + speed_w, b + speed_b
    return best[1].tolist(), (best[2] / scale[:, None]).T.tolist()


def _summed(docs: DataFrame, key: str, text: str, model: Classifier) -> DataFrame:
    """(__key, tokens, __s0, __s1 and so on, __n) for every row: the summed weights of its features by domain, and their number.

    Items become rows, which meet again under their document's number in the task that made them: compiled code, unlike lambdas over
    arrays, and one row for each document is moved."""
    words, shapes = _items(F.col(text))
    rows = docs.select(F.monotonically_increasing_id().alias("__row"), F.col(key).alias("__key"), words.alias("__words"), shapes.alias("__shapes"))
    items = rows.select("__row", "__key", F.size("__words").cast("long").alias("tokens"), F.posexplode_outer(F.concat("__words", "__shapes")).alias("__at", "__item"))
    item = F.col("__item")
    feature = F.when(F.col("__at") < F.col("tokens"), _stem(item)).when(item.isNotNull(), _shape(item))
    weights = [F.from_json(F.lit(json.dumps([round(x, 6) or 0 for x in w])), "array<double>") for w in model.weights]
    sums = [F.coalesce(F.sum(F.get(w, F.col("__f"))), F.lit(0.0)).alias(f"__s{d}") for d, w in enumerate(weights)]
    return items.withColumn("__f", feature).groupBy("__row", "__key", "tokens").agg(*sums, F.greatest(F.count("__f"), F.lit(1)).cast("double").alias("__n"))


def _summed_in_place(docs: DataFrame, kept: list[str], text: str, model: Classifier) -> DataFrame:
    """The same sums without a shuffle, with a struct of the columns kept as __key: for columns too wide to group by or to move."""
    weights = [F.from_json(F.lit(json.dumps([round(x, 6) or 0 for x in w])), "array<double>") for w in model.weights]
    sums = {f"__s{d}": _weigh(w) for d, w in enumerate(weights)}
    rows = docs.select(F.struct(*kept).alias("__key"), F.size(_items(F.col(text))[0]).cast("long").alias("tokens"), _features(F.col(text)).alias("__f"))
    return rows.withColumns(sums | {"__n": F.greatest(F.size("__f"), F.lit(1)).cast("double")}).drop("__f")


def _weigh(weights: Column) -> Column:
    return F.aggregate("__f", F.lit(0.0), lambda acc, f: acc + F.get(weights, f))


def _logits(model: Classifier) -> list[Column]:
    return [F.lit(b) + F.col(f"__s{d}") / F.col("__n") for d, b in enumerate(model.bias)]


def posteriors(docs: DataFrame, key: str, text: str, model: Classifier, keep: list[str] | None = None) -> DataFrame:
    """(key or the columns in keep, tokens, p array<double>) for every document."""
    names = [f"__l{d}" for d in range(len(model.bias))]
    summed = _summed_in_place(docs, keep, text, model) if keep else _summed(docs, key, text, model)
    scored = summed.select("__key", "tokens", *(x.alias(n) for n, x in zip(names, _logits(model), strict=True)))
    top = F.greatest(*names) if len(names) > 1 else F.col(names[0])
    odds = scored.select("__key", "tokens", *(F.exp(F.col(n) - top).alias(n) for n in names))
    total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    shares = odds.withColumn("p", F.array(*(F.col(n) / total for n in names)))
    own = [F.col("__key")[c].alias(c) for c in keep if c.lower() not in ("tokens", "p")] if keep else [F.col("__key").alias(key)]
    return shares.select(*own, "tokens", "p")


def solve_small(matrix: list[list[float]], right: list[float]) -> list[float]:
    """Gaussian elimination with pivoting, for as many unknowns as domains."""
    n = len(right)
    rows = [[*matrix[i], right[i]] for i in range(n)]
    for i in range(n):
        pivot = max(range(i, n), key=lambda k: abs(rows[k][i]))
        rows[i], rows[pivot] = rows[pivot], rows[i]
        for k in range(n):
            if k != i and rows[k][i]:
                f = rows[k][i] / rows[i][i]
                rows[k] = [a - f * b for a, b in zip(rows[k], rows[i], strict=True)]
    return [rows[i][n] / rows[i][i] for i in range(n)]


def rate(multipliers: list[float]) -> Column:
    """The rate of a document with posterior p."""
    return F.greatest(F.lit(0.0), F.lit(1.0) - sum((F.col("p")[i] * m for i, m in enumerate(multipliers)), F.lit(0.0)))


def fit_rates(scored: DataFrame, domains: list[str], weights: dict[str, float], budget: float = 1.0, tolerance: float = 1e-7) -> Mix:
    """Rates for expected domain tokens of budget * weight * all tokens; scored has tokens and p."""
    k = len(domains)

    def measured(tried: list[list[float]]) -> list[tuple[float, list[float], list[list[float]]]]:
        """Half the squared rates, totals by domain and the Gram matrix of the documents that can move, at each multipliers."""
        t = F.col("tokens").cast("double")
        rates = scored.select(t.alias("t"), "p", *(rate(m).alias(f"x{c}") for c, m in enumerate(tried)))
        sums = []
        for c in range(len(tried)):
            x, p = F.col(f"x{c}"), [F.col("p")[i] for i in range(k)]
            sums.append(F.sum(F.col("t") * x * x / 2).alias(f"h{c}"))
            sums += [F.sum(F.col("t") * x * p[i]).alias(f"a{c}_{i}") for i in range(k)]
            sums += [F.sum(F.when(x > 0, F.col("t") * p[i] * p[j]).otherwise(0.0)).alias(f"g{c}_{i}_{j}") for i in range(k) for j in range(i, k)]
        got = rates.agg(*sums).first()
        return [(got[f"h{c}"], [got[f"a{c}_{i}"] for i in range(k)], [[got[f"g{c}_{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)]) for c in range(len(tried))]

    total = float(scored.agg(F.sum("tokens")).first()[0] or 0)
    if not total:
        return Mix([0.0] * k, [0.0] * k, [0.0] * k, 0.0, 0)
    targets = [budget * total * weights[d] / sum(weights.values()) for d in domains]

    def cost(half: float, m: list[float]) -> float:
        """What the multipliers minimise: its gradient is what the targets still lack, less the pull."""
        return half / total + sum(x * t / total + PULL * x * x / 2 for x, t in zip(m, targets, strict=True))

    at = [0.0] * k
    half, reached, gram = measured([at])[0]
    rounds = 0
    while True:
        gap = [(a - t) / total - PULL * m for a, t, m in zip(reached, targets, at, strict=True)]
        residual = max(map(abs, gap))
        if residual <= tolerance:
            return Mix(at, targets, reached, residual, rounds)
        scaled = [[x / total + (PULL if i == j else 0.0) for j, x in enumerate(row)] for i, row in enumerate(gram)]
        newton = solve_small(scaled, gap)
        tried = [[m + g / (1 + PULL) for m, g in zip(at, gap, strict=True)], *([m + d * s for m, s in zip(at, newton, strict=True)] for d in DAMPING)]
        found = measured(tried)
        best = min(range(len(tried)), key=lambda c: cost(found[c][0], tried[c]))
        if cost(found[best][0], tried[best]) >= cost(half, at):
            return Mix(at, targets, reached, residual, rounds)
        at, (half, reached, gram), rounds = tried[best], found[best], rounds + 1


def told(mix_: Mix, domains: list[str]) -> str:
    """What was asked and what was reached, for the log."""
    parts = [f"{d}: {a:.0f} of {t:.0f} tokens" for d, t, a in zip(domains, mix_.targets, mix_.reached, strict=True)]
    return f"{', '.join(parts)}; {mix_.rounds} rounds, residual {mix_.residual:.2g}"


def mix(docs: DataFrame, key: str, text: str, labels: DataFrame, label_key: str, domain: Column, weights: dict[str, float], budget: float = 1.0, max_rows: int = 8000) -> DataFrame:
    """(key, tokens, p, rate) for every document; the log says how near the totals came."""
    domains = sorted(weights)
    model = fit(docs, key, text, labels, label_key, domain, domains, max_rows)
    scored = materialise(posteriors(docs, key, text, model), "posteriors")
    found = fit_rates(scored, domains, weights, budget)
    log.info("mixing: %s", told(found, domains))
    return scored.withColumn("rate", rate(found.multipliers))


def copies(key: Column, rate_: Column, seed: int = 11) -> Column:
    """Whole copies of a document: the rate's floor, and one more for a hash of the key below its fraction."""
    chance = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (F.floor(rate_) + (chance < rate_ - F.floor(rate_)).cast("int")).cast("int")
