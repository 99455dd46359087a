"""Mixing to target weights with soft domain membership.

A classifier trained on a labelled table gives each document a posterior over
domains. Nonnegative document rates ``r`` are fitted so that the expected
tokens of every domain, ``sum(tokens * posterior * r)``, match targets in least
squares, by projected gradient steps from ``r = 1``:
``r = max(0, r - posterior . step)``. A step is the gradient scaled by the Gram
matrix of the documents with a positive rate (one number per pair of domains,
summed over all documents in one Spark job), so a few steps suffice. Rates
follow from a document's posterior and the list of steps; no state per document
is kept between steps.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.llm import linear
from tickweave.llm.work import ID, TEXT, hold, whole_rows

# The labelled table's domains, and their default target shares of tokens.
TARGETS = {"good": 0.80, "low": 0.14, "toxic": 0.06}
MOST = 6_000  # label rows per domain that the classifier is trained on at most


def domain_of_labels(quality: str = "quality", toxic: str = "toxic") -> Column:
    """Domain number by label: 2 toxic, 1 low quality, 0 good; null where neither label says."""
    return (F.when(F.col(toxic) == 1, 2).when(F.col(quality) == 0, 1)
            .when((F.col(quality) == 1) & F.coalesce(F.col(toxic) == 0, F.lit(True)), 0))


def train(docs: DataFrame, labels: DataFrame, domain: Column, k: int, most: int = MOST, id_col: str = "doc_id",
          text_col: str = "text") -> linear.Model:
    """A softmax over ``k`` domains, from at most ``most`` label rows of each (see :func:`linear.sample`)."""
    rows = labels.withColumn("__domain", domain).filter("__domain is not null")
    n = dict(rows.groupBy("__domain").count().collect())  # at most k rows
    shares = [n.get(c, 0) for c in range(k)]
    got = linear.sample(docs, rows, F.col("__domain"), {c: most for c in range(k)}, id_col, text_col)
    return linear.fit(got, list(range(k)), [s / max(1, sum(shares)) for s in shares])


def scored_columns(model: linear.Model, k: int, text_col: str = "text") -> tuple[Column, Column]:
    """Tokens of a text (its words, runs of letters and digits; none for a null) and ``array<double>`` of ``k`` posteriors."""
    got = model.column(text_col, count=True)
    return got[0].cast("long"), F.array(1 - got[1], got[1]) if k == 2 else F.slice(got, 2, k)


def rate(p: str, steps: list[list[float]], least: float = 0.0) -> Column:
    """The rate of a document with posterior column ``p`` after ``steps``, none below ``least``."""
    r = F.lit(1.0)
    for step in steps:
        dot = sum((F.col(p)[i] * F.lit(float(s)) for i, s in enumerate(step)), F.lit(0.0))
        r = F.greatest(F.lit(least), r - dot)
    return r


def _descend(rows: DataFrame, matrix: np.ndarray, goal: np.ndarray, least: float, scale: float, tolerance: float,
             most_steps: int) -> tuple[list[list[float]], np.ndarray, np.ndarray]:
    """Projected-gradient least squares over rates of ``least`` or more: ``matrix @ sums`` brought nearest to ``goal``.

    Gives the steps, and the domains' tokens before and after. Each step is the
    gradient scaled by the Gram matrix of the documents above ``least`` (at the
    start: of all); one that overshoots is halved. Ends within ``tolerance`` of
    ``scale``, when steps no longer help, or after ``most_steps``.
    """
    k = matrix.shape[1]

    def sums(steps):
        r = rows.select("tokens", "p", rate("p", steps, least).alias("r"))
        free = F.col("r") > least if steps else F.lit(True)
        cells = [F.sum(F.col("tokens") * F.col("p")[i] * F.col("r")).alias(f"s{i}") for i in range(k)] + [
            F.sum(F.when(free, F.col("tokens") * F.col("p")[i] * F.col("p")[j])).alias(f"g{i}_{j}")
            for i in range(k) for j in range(i, k)]
        got = r.agg(*cells).first()
        s = np.array([got[f"s{i}"] or 0.0 for i in range(k)])
        g = np.array([[got[f"g{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(k)] for i in range(k)])
        return s, g

    steps: list[list[float]] = []
    s, g = sums(steps)
    before = s
    while np.abs(matrix @ s - goal).max() > tolerance * scale and len(steps) < most_steps:
        gap = matrix @ s - goal
        gram = matrix @ g @ matrix.T
        step = matrix.T @ np.linalg.lstsq(gram + np.eye(k) * 1e-9 * np.trace(gram), gap, rcond=None)[0]
        for _ in range(16):  # halve a step that overshoots
            s2, g2 = sums([*steps, step.tolist()])
            if np.linalg.norm(matrix @ s2 - goal) < np.linalg.norm(gap):
                break
            step = step / 2
        else:
            break
        gain = 1 - np.linalg.norm(matrix @ s2 - goal) / np.linalg.norm(gap)
        steps.append(step.tolist())
        s, g = s2, g2
        if gain < 1e-4:
            break
    return steps, before, s


def _start(rows: DataFrame, k: int) -> np.ndarray:
    """Tokens of each domain at rates of 1."""
    got = rows.agg(*[F.sum(F.col("tokens") * F.col("p")[i]).alias(f"s{i}") for i in range(k)]).first()
    return np.array([got[f"s{i}"] or 0.0 for i in range(k)])


def fit_rates(rows: DataFrame, weights: list[float], total: float | None = None, tolerance: float = 1e-4,
              most_steps: int = 40) -> tuple[list[list[float]], dict]:
    """The steps whose :func:`rate` brings ``rows (tokens, p)`` to ``weights`` of ``total`` tokens.

    ``total``: default, the least at which no domain has to shrink. Stops when
    every domain is within ``tolerance`` of the total, when steps no longer
    help (targets out of reach), or after ``most_steps``. An empty table gives
    no steps. ``info["missed"]`` is the largest gap of a share.
    """
    k = len(weights)
    w = np.array(weights, float) / sum(weights)
    before = _start(rows, k)
    if not before.sum():
        return [], {"total": 0.0, "before": before.tolist(), "after": before.tolist(), "targets": [0.0] * k, "missed": 0.0}
    total = total if total is not None else float(max(before[i] / w[i] for i in range(k) if w[i] > 0))
    steps, before, s = _descend(rows, np.eye(k), w * total, 0.0, total, tolerance, most_steps)
    return steps, {"total": total, "before": before.tolist(), "after": s.tolist(), "targets": (w * total).tolist(),
                   "missed": _missed(s, w)}


def _missed(s: np.ndarray, w: np.ndarray) -> float:
    return float(np.abs(s / s.sum() - w).max()) if s.sum() else 0.0


def fit_staying(rows: DataFrame, weights: list[float], total: float | None = None, tolerance: float = 1e-4,
                most_growth: float = 2.0, most_steps: int = 40) -> tuple[list[list[float]], dict]:
    """As :func:`fit_rates`, with rates of 1 or more, so that no document is left out (``rate`` with ``least`` 1).

    The total is free, unless given: least squares of the gaps of the shares.
    Shares that take more than ``most_growth`` times the least total at which
    no domain has to shrink, or that no such rates reach, are missed: then
    totals are brought as near as can be to ``weights`` of that least total.
    ``info["missed"]`` is the largest gap of a share.
    """
    k = len(weights)
    w = np.array(weights, float) / sum(weights)
    before = _start(rows, k)
    if not before.sum():
        return [], {"total": 0.0, "before": before.tolist(), "after": before.tolist(), "targets": [0.0] * k, "missed": 0.0}
    least = float(max(before[i] / w[i] for i in range(k) if w[i] > 0))
    steps, s = [], before
    if total is None:  # every domain's tokens less its share of the total: none
        steps, _, s = _descend(rows, np.eye(k) - np.outer(w, np.ones(k)), np.zeros(k), 1.0, least, tolerance, most_steps)
    if total is not None or _missed(s, w) > tolerance * 10 or s.sum() > most_growth * least:
        steps, _, s = _descend(rows, np.eye(k), w * (total or least), 1.0, total or least, tolerance, most_steps)
        if s.sum() > most_growth * max(total or least, before.sum()):
            steps, s = [], before
    return steps, {"total": float(s.sum()), "before": before.tolist(), "after": s.tolist(),
                   "targets": (w * s.sum()).tolist(), "missed": _missed(s, w)}


def rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, domain: Column | None = None,
          total: float | None = None, id_col: str = "doc_id", text_col: str = "text",
          keep: list[str] | None = None, all_stay: bool = False) -> tuple[DataFrame, dict]:
    """``docs`` with ``tokens``, ``p`` (posterior per domain), ``rate`` and ``copies``; and the fit's totals.

    ``all_stay``: rates are 1 or more, so that no document is left out; shares
    that such rates do not reach are missed (see :func:`fit_staying`).
    ``keep``: columns of ``docs`` that come back beside them, from the table
    the rates are fitted on; by default all, scored again as the result is read
    (so that texts are not kept twice).

    ``copies`` is the rate rounded up or down by a hash of the id, so that the
    expected number of copies is the rate. All rows come back (columns of those
    names are replaced). A null or empty text has no tokens
    and a rate like any other. Labels may be null, repeated or of unknown ids;
    without labels every posterior is the same and rates are 1 or a constant.
    """
    targets = targets or TARGETS
    k = len(targets)
    model = train(docs, labels, domain_of_labels() if domain is None else domain, k, MOST, id_col, text_col)
    tokens, p = scored_columns(model, k, text_col)
    scored = docs.withColumns({"tokens": tokens, "p": p})
    own = ("tokens", "p", "rate", "copies")
    fitted = hold(scored.select(*[c for c in keep or [] if c not in own], "tokens", "p"))
    fit, least = (fit_staying, 1) if all_stay else (fit_rates, 0)
    steps, info = fit(fitted, list(targets.values()), total)
    scored = scored if keep is None else fitted
    u = F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.lit("copies")), 11).cast("double") / F.lit(float(2 ** 53))
    out = scored.withColumn("rate", rate("p", steps, float(least))).withColumn(
        "copies", F.greatest(F.lit(least), F.floor("rate") + (u < F.col("rate") - F.floor("rate")).cast("int"))
        .cast("int"))
    return out, info | {"steps": len(steps)}


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, domain: Column | None = None,
        total: float | None = None, id_col: str = "doc_id", text_col: str = "text",
        all_stay: bool = False) -> DataFrame:
    """The mixed corpus: the columns of ``docs``, whatever their names, each row as often as its ``copies``."""
    out, _ = rates(whole_rows(docs, id_col, text_col), labels.withColumnRenamed(id_col, ID), targets, domain, total, ID,
                   TEXT, all_stay=all_stay)
    return out.select("__row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("__row.*")
