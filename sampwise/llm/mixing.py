"""Mixing sources to target weights with soft domain membership.

A classifier fitted on a labelled table gives every document a posterior over the
domains.  Each document i gets a rate r_i >= 0, the expected number of its copies in
the mix, such that the expected tokens of each domain,

    A_k = sum_i r_i * tokens_i * p_ik,

match the target totals T.  Projected gradient descent on the least-squares misfit
(A - T)' G^-1 (A - T), with G = sum_i tokens_i p_i p_i' and steps in the token metric,
starts from r = 1.  G^-1 makes one the safe step length: a step is
``r_i <- max(0, r_i - p_i . G^-1 (A - T))``.  The Gram matrix of only the rows whose rate
is above zero gives a longer step, which is taken when it lowers the misfit.

``mix`` anchors the rates: rows that are at least half of domain ``keep`` stand in the mix exactly once.
The other rows' rates are fitted to the shares at the total that they themselves give: with s the
shares, projected gradient on sum_i r_i tokens_i (p_i - s) = 0 from r = 1.  So no anchored row is
dropped, the total is the least one that meets the shares, and it is below all tokens wherever the
others have to shrink.  Its posteriors are first calibrated (``calibrated``): one slope and a bias per domain,
fitted on labelled rows that the classifier did not see.  What the run reaches against what is
wanted is logged, and where the shares cannot be met the misfit left is the least one.

The work is distributed: a step needs one or two aggregates of K + K*K sums over the
stored posteriors.  A document's rate is a fold over the steps' K-vectors, so no rate is ever
stored or sent; the driver holds one K-vector per step.

Defined cases: null and empty texts have no tokens and change no total; their rate is 1.
With no tokens at all every rate is 1.  A domain without mass
cannot be met; the remaining misfit is the least one.  Repeated rows are
documents of their own; other columns are ignored (or passed through by ``mix``).
"""

from __future__ import annotations

import logging

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampwise.llm.shared import fresh, stored, text_or_empty
from sampwise.llm.subword import SubwordModel, train

DOMAINS = ("low_quality", "clean", "toxic")
#: More steps than the default: a toxic text differs from a clean one by a few words.
TRAINING = {"epochs": 12, "rate": 4.0}
#: One labelled row in this many is not learned from but calibrates the posteriors.
CALIBRATION = 5
_LOG = logging.getLogger(__name__)


def domain_label() -> Column:
    """The class of a row of labels: 0 low quality, 1 clean, 2 toxic."""
    return (F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 2)
            .when(F.col("quality") == 1, 1))


def _vector(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def rate_of(p: Column, n_words: Column, steps: list[np.ndarray], keep: int | None = None) -> Column:
    """The rate after all steps: a fold from 1 with projection to 0 or more; 1 without tokens and
    for rows that are at least half of domain ``keep``."""
    if not steps:
        return F.lit(1.0)
    rows = F.array(*[_vector(s) for s in steps])
    rate = F.aggregate(rows, F.lit(1.0), lambda r, s: F.greatest(r - _dot(p, s), F.lit(0.0)))
    return F.when((n_words == 0) | _anchored(p, keep), F.lit(1.0)).otherwise(rate)


def _anchored(p: Column, keep: int | None) -> Column:
    return F.lit(False) if keep is None else F.coalesce(F.get(p, F.lit(keep)) >= 0.5, F.lit(False))


def fit_rates(members: DataFrame, shares: tuple[float, ...], total: float | None = None,
              tolerance: float = 1e-7, max_steps: int = 40, keep: int | None = None) -> list[np.ndarray]:
    """Steps that bring the domain totals to ``shares`` of ``total`` tokens (all tokens); with ``keep``,
    to the shares of the total that results while that domain's rows keep rate 1.

    ``members`` has columns p (posteriors) and n_words (tokens).
    """
    k = len(shares)
    share = np.array(shares, dtype=float) / sum(shares)
    shift = np.zeros(k) if keep is None else share
    p = [F.get("p", F.lit(i)) for i in range(k)]
    x = [q - F.lit(float(c)) for q, c in zip(p, shift)]

    def sums(steps):
        """Tokens in all, the domain totals and the Gram matrix over free rows with a rate above 0."""
        own, rate = F.col("n_words"), F.col("rate")
        live = F.when((rate > 0) & ~_anchored(F.col("p"), keep), own).otherwise(0)
        row = members.withColumn("rate", rate_of(F.col("p"), own, steps, keep)).agg(
            F.sum(own), *[F.sum(own * rate * q) for q in p],
            *[F.sum(live * y * z) for y in x for z in x]).first()
        values = np.array([v or 0 for v in row], dtype=float)
        return values[0], values[1:k + 1], values[k + 1:].reshape(k, k)

    def misses(got):
        """Distance of the totals from the wanted ones."""
        return got - target if keep is None else got - share * got.sum()

    def step_of(metric, miss):
        v = metric @ miss  # (p - s) . v, as a plain product with p: the entries of p add up to 1
        return v - shift @ v

    tokens, got, gram = sums([])
    if not tokens:
        return []
    target = share * (tokens if total is None else total)
    safe = np.linalg.pinv(gram, rcond=1e-12)
    steps, miss, active = [], misses(got), gram
    for _ in range(max_steps):
        misfit = miss @ safe @ miss
        if np.abs(miss).sum() <= tolerance * target.sum():
            break
        # the metric of the rows that still move is the longer step; kept only if it helps
        for metric in (np.linalg.pinv(active, rcond=1e-12), safe):
            trial = [*steps, step_of(metric, miss)]
            _, trial_got, gram = sums(trial)
            after = misses(trial_got) @ safe @ misses(trial_got)
            if after < misfit:
                break
        if after >= misfit * (1 - 1e-6):
            break  # the least misfit that rates >= 0 allow
        steps, got, miss, active = trial, trial_got, misses(trial_got), gram
    reached = got / max(got.sum(), 1e-9)
    far = np.abs(reached - share).sum() > 1e-3
    _LOG.log(logging.WARNING if far else logging.INFO, "mix of %.0f of %.0f tokens: shares %s, wanted %s",
             got.sum(), tokens, np.round(reached, 5).tolist(), np.round(share, 5).tolist())
    return steps


def calibrated(model: SubwordModel, docs: DataFrame, labels: DataFrame, label: Column, n_classes: int,
               id_col: str, text_col: str, most: int = 600) -> SubwordModel:
    """``model`` with a slope and a bias per class added to its logits that fit labelled rows it has not seen.

    At most ``most`` rows, those of least hash of the id; targets are smoothed by one
    row per class, so separable rows do not make the slope endless.
    """
    usable = labels.select(F.col(id_col).cast("long").alias("id"), label.cast("int").alias("y")).where(
        F.col("y").isNotNull() & _calibrates(F.col("id")))
    one = usable.groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("other")).where("y = other")
    few = (docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
           .join(one.select("id", "y"), "id").groupBy("id").agg(F.min("text").alias("text"), F.first("y").alias("y"))
           .orderBy(F.xxhash64("id"), "id").limit(most))
    rows = model.score(few, "id", "text").join(few.select("id", "y"), "id").select("p", "y").collect()
    if not rows:
        return model
    z = np.log(np.maximum(np.array([r["p"] for r in rows]), 1e-12))
    y = np.array([r["y"] for r in rows])
    n = np.bincount(y, minlength=n_classes)
    goal = np.where(np.arange(n_classes)[None, :] == y[:, None], (n[y] + 1)[:, None], 1.0)
    goal /= goal.sum(axis=1, keepdims=True)
    slope, bias = 1.0, np.zeros(n_classes)
    past = np.full(n_classes + 1, 1e-8)
    for _ in range(2000):
        q = np.exp(slope * z + bias - (slope * z + bias).max(axis=1, keepdims=True))
        q /= q.sum(axis=1, keepdims=True)
        wrong = (q - goal) / len(z)
        step = np.r_[(wrong * z).sum(), wrong.sum(axis=0)]
        past += step ** 2
        step = 0.5 * step / np.sqrt(past)
        slope, bias = max(slope - step[0], 1e-3), bias - step[1:]
    return SubwordModel(model.table[:-1] * slope, model.bias * slope + bias - bias[0])


def _calibrates(id_col: Column) -> Column:
    return F.pmod(F.xxhash64(id_col, F.lit("calibration")), F.lit(CALIBRATION)) == 0


def mixing_rates(docs: DataFrame, labels: DataFrame, shares: tuple[float, ...], label: Column | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_words, p, rate), one per input row."""
    label = domain_label() if label is None else label
    model = train(docs, labels, label, len(shares), id_col=id_col, text_col=text_col, **TRAINING)
    members = stored(model.score(docs, id_col, text_col), "mixing-members")
    return members.withColumn("rate", rate_of(F.col("p"), F.col("n_words"), fit_rates(members, shares)))


def copies_of(rate: Column, id_col: Column, seed: int = 1) -> Column:
    """Whole copies with the rate as their mean: floor(rate + u), u in [0, 1) from the id."""
    u = F.pmod(F.xxhash64(id_col, F.lit(seed)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return F.floor(rate + u).cast("int")


def mix(docs: DataFrame, labels: DataFrame, shares: tuple[float, ...], label: Column | None = None,
        id_col: str = "doc_id", text_col: str = "text", keep: int | None = None) -> DataFrame:
    """``docs`` with every row repeated as its rate says, columns unchanged, without a shuffle.
    Rows that are at least half of domain ``keep`` stand in it once.

    The rows are stored once together with their posteriors, so the documents are
    scored once and the rates are applied in the scan that reads them back.
    """
    label = domain_label() if label is None else label
    seen = None if keep is None else ~F.coalesce(_calibrates(F.col(id_col).cast("long")), F.lit(False))
    model = train(docs, labels, label, len(shares), where=seen, id_col=id_col, text_col=text_col, **TRAINING)
    if keep is not None:
        model = calibrated(model, docs, labels, label, len(shares), id_col, text_col)
    p, n = fresh(docs, "mix_p", "mix_words")
    scored = stored(model.annotate(docs, text_col, p, n), "mixing-rows")
    members = scored.select(F.col(p).alias("p"), F.col(n).alias("n_words"))
    steps = fit_rates(members, shares, keep=keep)
    copies = copies_of(rate_of(F.col(p), F.col(n), steps, keep), F.col(id_col))
    times = F.explode(F.array_repeat(F.lit(0), copies)).alias(n)
    return scored.select(*[F.col(f"`{c}`") for c in docs.columns], times).drop(n)
