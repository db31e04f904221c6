"""Mixing by soft membership: rates whose expected domain tokens meet targets.

A multinomial logistic regression on hashed words, fitted on a labelled table,
gives every document a probability for each domain. A document belongs to all
domains in these proportions. Nonnegative document rates are then fitted by
projected-gradient least squares so that the expected tokens of each domain,
``sum(rate * tokens * probability)``, meet the target weights.

The gradient needs one number per domain from all documents; the driver holds
these numbers only. A rate is a function of the document's probabilities and
of the steps so far, so it is computed where it is needed, never stored.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewise.llm.common import fresh, stage

#: Hashed words, and the labelled rows that the classifier is fitted on: about
#: this many, those with the smallest id hashes (all, if there are fewer).
BUCKETS, FIT_ROWS = 1 << 14, 20_000
ITERATIONS, REGULARISATION = 40, 0.002
#: Gradient steps at most, and the relative error of the totals that ends them.
STEPS, TOLERANCE = 60, 1e-4

#: Domains of the labelled table and the targets of the registered query.
TARGETS = {"good": 0.96, "poor": 0.01, "toxic": 0.03}


class Kept(dict):
    """Targets of which the ``wanted`` domains lose no document: a document
    whose likeliest domain is wanted has a rate of 1 at least, and no other
    domain's target is above its share of the expected tokens of the input."""

    def __init__(self, targets: Mapping[str, float], wanted: set[str]) -> None:
        super().__init__(targets)
        self.wanted = frozenset(wanted)


def domain_of_labels() -> Column:
    """toxic, else good (quality 1), else poor; null if quality and toxic are null."""
    return (F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good")
            .when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), "poor"))


def words(text: Column) -> Column:
    """Words of a text, white space apart; an empty or null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")


def terms(found: Column) -> Column:
    """What the classifier sees of a text: its different words, and the last
    letters of those (it asks for presence only)."""
    found = F.array_distinct(found)
    last = F.array_distinct(F.transform(found, lambda w: F.substring(w, -1, 1)))
    return F.concat(found, F.transform(last, lambda x: F.concat(F.lit(" "), x)))


def hashed(rows: DataFrame, terms_col: str, out: str) -> DataFrame:
    return HashingTF(inputCol=terms_col, outputCol=out, numFeatures=BUCKETS, binary=True).transform(rows)


def learn(docs: DataFrame, labelled: DataFrame, domains: list[str], id_col: str = "doc_id",
          text_col: str = "text", fit_rows: int = FIT_ROWS) -> LogisticRegressionModel | None:
    """Fit on documents with a row (doc_id, domain) in ``labelled``.

    About ``fit_rows`` labelled ids are used, which bounds the texts that are
    read for the fit; how they are joined is left to Spark. None if fewer than two
    domains have a document.
    """
    known = labelled.where(F.col("domain").isin(domains) & F.col("doc_id").isNotNull())
    total = known.count()
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("fit")), 11).cast("double") / F.lit(float(1 << 53))
    index = F.array_position(F.array(*[F.lit(d) for d in domains]), F.col("domain")) - 1
    used = known.where(draw < fit_rows / max(1, total)).select(
        F.col("doc_id").alias("l_id"), index.cast("double").alias("label"))
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    rows = stage(texts.join(used, F.col("doc_id") == F.col("l_id"))
                 .select("label", terms(words(F.col("text"))).alias("terms")), "mixing-fit")
    if len(rows.select("label").distinct().limit(2).collect()) < 2:
        return None
    model = LogisticRegression(featuresCol="features", labelCol="label", family="multinomial", maxIter=ITERATIONS,
                               regParam=REGULARISATION)
    return model.fit(hashed(rows, "terms", "features"))


def posteriors(docs: DataFrame, model: LogisticRegressionModel | None, domains: list[str], out: str, tokens: str,
               text_col: str = "text") -> DataFrame:
    """``docs`` with its word count ``tokens`` and the probabilities ``out``
    (array in the order of ``domains``; all equal without a model)."""
    k = len(domains)
    counted = fresh(docs, "mix_words")
    rows = docs.withColumn(counted, words(F.col(f"`{text_col}`"))).withColumn(tokens, F.size(counted).cast("long"))
    if model is None:
        return rows.withColumn(out, F.array(*[F.lit(1.0 / k)] * k)).drop(counted)
    seen, features, chance = (fresh(docs, n) for n in ("mix_terms", "mix_features", "mix_probability"))
    rows = hashed(rows.withColumn(seen, terms(F.col(counted))), seen, features)
    model = model.copy()
    model.setFeaturesCol(features).setProbabilityCol(chance).setRawPredictionCol("").setPredictionCol("")
    rows = model.transform(rows).withColumn(out, vector_to_array(chance))
    # the fit knows the domains up to the last one that it met
    have = model.numClasses
    if have < k:
        rows = rows.withColumn(out, F.concat(out, F.array(*[F.lit(0.0)] * (k - have))))
    return rows.drop(counted, seen, features, chance)


def likeliest(chance: Column) -> Column:
    """Place of the largest probability, from 1; of equal ones the first."""
    return F.array_position(chance, F.array_max(chance)).cast("int")


def least_rate(chance: Column, domains: list[str], targets: Mapping[str, float]) -> Column:
    """1 for documents whose likeliest domain is wanted, else 0."""
    wanted = [i + 1 for i, d in enumerate(domains) if d in getattr(targets, "wanted", ())]
    return F.when(likeliest(chance).isin(wanted), 1.0).otherwise(0.0) if wanted else F.lit(0.0)


def moved(chance: Column, steps: list[list[float]], least: Column | None = None) -> Column:
    """Struct (r, y) of a document after the gradient ``steps``, from rate 1.

    A step is (gain, one number per domain): from the point y the document
    moves along its probabilities, and to ``least`` (zero) if it fell below;
    that is its rate r. The next y lies beyond r by ``gain`` times the way that r has gone.
    """
    start = F.struct(F.lit(1.0).alias("r"), F.lit(1.0).alias("y"))
    if not steps:
        return start
    rows = F.array(*[F.array(*[F.lit(float(x)) for x in s]) for s in steps])
    k = len(steps[0]) - 1
    least = F.lit(0.0) if least is None else least

    def step(at: Column, s: Column) -> Column:
        slope = sum((chance[i] * s[i + 1] for i in range(1, k)), chance[0] * s[1])
        r = F.greatest(least, at["y"] - slope)
        return F.struct(r.alias("r"), (r + s[0] * (r - at["r"])).alias("y"))

    return F.aggregate(rows, start, step)


def rate(chance: Column, steps: list[list[float]], least: Column | None = None) -> Column:
    return moved(chance, steps, least)["r"]


def present_shares(known: DataFrame, k: int, chance: str, tokens: str) -> list[float]:
    """Share of every domain in the expected tokens of ``known`` (zeros without tokens)."""
    sums = known.agg(*[F.sum(F.col(tokens) * F.col(chance)[i]) for i in range(k)]).first()
    total = sum(x or 0.0 for x in sums)
    return [(x or 0.0) / total if total else 0.0 for x in sums]


def aims(known: DataFrame, domains: list[str], targets: Mapping[str, float], chance: str, tokens: str) -> list[float]:
    """The target weights in the order of ``domains``. With :class:`Kept`
    targets the domains that are not wanted get at most their present share,
    and the wanted ones the rest, in the proportion of their targets."""
    total = sum(targets.values())
    aim = [targets[d] / total for d in domains]
    wanted = getattr(targets, "wanted", ())
    rest = sum(x for x, d in zip(aim, domains, strict=True) if d in wanted)
    if not rest:
        return aim
    now = present_shares(known, len(domains), chance, tokens)
    if all(x >= n for x, n, d in zip(aim, now, domains, strict=True) if d not in wanted):
        capped = now  # nothing to take away: the input is the mixture
    else:
        capped = [min(x, n) for x, n in zip(aim, now, strict=True)]
        left = 1 - sum(x for x, d in zip(capped, domains, strict=True) if d not in wanted)
        capped = [x / rest * left if d in wanted else c for x, c, d in zip(aim, capped, domains, strict=True)]
    return capped if any(capped) else aim


def solve(known: DataFrame, targets: list[float], chance: str, tokens: str, least: Column | None = None
          ) -> tuple[list[list[float]], float]:
    """Steps that bring the expected tokens of the domains to the targets, and
    how far the worst total is off after them, in parts of the largest target.

    Accelerated projected gradient for least squares in the norm of the
    domains' second moments: a step of length 1 would end it if no rate were
    held at ``least`` (zero). The gain grows with the steps and falls back to zero when
    the error has grown. Each pass over the stored ``known`` returns two sums
    per domain.
    """
    k = len(targets)
    t, p = F.col(tokens), F.col(chance)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    sums = known.agg(F.coalesce(F.sum(t), F.lit(0)), *[F.coalesce(F.sum(t * p[i] * p[j]), F.lit(0.0)) for i, j in pairs]).first()
    moments = np.zeros((k, k))
    for (i, j), x in zip(pairs, sums[1:], strict=True):
        moments[i, j] = moments[j, i] = x
    weight = np.array(targets, dtype=float)
    goal = float(sums[0]) * weight / weight.sum()
    inverse = np.linalg.pinv(moments, rcond=1e-9)
    steps: list[list[float]] = []
    error, since, far = float("inf"), 0, 0.0
    while sums[0]:
        now = known.select(moved(p, steps, least).alias("at"), t.alias("t"), p.alias("p"))
        have = now.agg(*[F.sum(F.col(f"at.{x}") * F.col("t") * F.col("p")[i]) for x in "ry" for i in range(k)]).first()
        off, ahead = np.array(have[:k], dtype=float) - goal, np.array(have[k:], dtype=float) - goal
        far = float(np.abs(off).max() / goal.max())
        if far <= TOLERANCE or len(steps) == STEPS:
            break
        since = since + 1 if off @ inverse @ off <= error else 0
        error = off @ inverse @ off
        steps.append([since / (since + 3), *(inverse @ ahead).tolist()])
    return steps, far


def copies(of: Column, key: Column) -> Column:
    """Whole copies whose expectation is the rate: a hash of the key decides the rest."""
    draw = F.shiftrightunsigned(F.xxhash64(key, F.lit("copies")), 11).cast("double") / F.lit(float(1 << 53))
    return F.floor(of + draw).cast("int")


def _fitted(docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float], id_col: str, text_col: str
            ) -> tuple[list[str], LogisticRegressionModel | None]:
    domains = sorted(targets)
    if not domains or min(targets.values()) < 0 or not sum(targets.values()):
        raise ValueError("targets are nonnegative weights, one of them positive")
    return domains, learn(docs, labelled, domains, id_col, text_col)


def _steps(known: DataFrame, domains: list[str], model: LogisticRegressionModel | None, targets: Mapping[str, float],
           chance: str, tokens: str, least: Column) -> tuple[list[list[float]], float | None]:
    if model is None:
        return [], None
    return solve(known, aims(known, domains, targets, chance, tokens), chance, tokens, least)


def mix(docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float], id_col: str = "doc_id",
        text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, tokens, domain (the likeliest),
    posterior (probabilities by domain name), rate, copies, and off: how far
    the worst domain's expected tokens are from the target after the last step,
    in parts of the largest target (TOLERANCE at most, or the steps ran out
    or no rates meet the targets; null without a model).

    The expected tokens of all domains together stay what they are. Null and
    empty texts have no tokens: they weigh nothing and get the rate of their
    probabilities. Targets that no nonnegative rates can meet are met as
    closely as the least squares allow. :class:`Kept` targets follow the input
    and bound the rates of wanted documents. Without a model nothing tells the
    documents apart, and their rates are 1 then.
    """
    domains, model = _fitted(docs, labelled, targets, id_col, text_col)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    known = stage(posteriors(rows, model, domains, "chance", "tokens").drop("text"), "mixing")
    p = F.col("chance")
    least = least_rate(p, domains, targets)
    steps, off = _steps(known, domains, model, targets, "chance", "tokens", least)
    return known.withColumn("rate", rate(p, steps, least)).select(
        "doc_id", "tokens", F.element_at(F.array(*[F.lit(d) for d in domains]), likeliest(p)).alias("domain"),
        F.map_from_arrays(F.array(*[F.lit(d) for d in domains]), p).alias("posterior"), "rate",
        copies(F.col("rate"), F.col("doc_id")).alias("copies"), F.lit(off).cast("double").alias("off"))


def resample(docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float], id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``docs`` with every row repeated as often as :func:`mix` says (0: left out)."""
    domains, model = _fitted(docs, labelled, targets, id_col, text_col)
    chance, tokens, times = (fresh(docs, n) for n in ("mix_chance", "mix_tokens", "mix_times"))
    # the classifier runs once a row: its probabilities are written beside the row
    known = stage(posteriors(docs, model, domains, chance, tokens, text_col), "mixing")
    least = least_rate(F.col(chance), domains, targets)
    steps, _ = _steps(known, domains, model, targets, chance, tokens, least)
    drawn = known.withColumn(times, copies(rate(F.col(chance), steps, least), F.col(f"`{id_col}`")))
    return (drawn.where(F.col(times) > 0).withColumn(times, F.explode(F.array_repeat(F.lit(0), F.col(times))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
