"""Mixing to target weights with soft domain membership.

Domains are ``good``, ``low`` (quality 0) and ``toxic``, as the table ``labels`` has
them for some documents.  A classifier learned from the labelled rows gives every
document a posterior over the domains; the rates r >= 0 of the documents are then
fitted by projected gradient so that the expected token totals
``sum r * tokens * posterior`` match the targets.

*Classifier*.  Features are the distinct lower-cased words, the last three
characters of each word, and the tenth of words that repeat their neighbour.
A feature speaks for a domain by a lower confidence bound of its log odds; every
feature that speaks for one is kept (by its full hash), at least ten rows each, so their
number is bounded by the labelled rows that are read.  The evidence for each domain is cut into levels, and the posterior of
a document is the share of each domain among labelled documents of the same
levels.  Where there are none, each domain's level counts by itself, as if levels were
independent within a domain: the domains' shares times the smoothed share of each level
in them.  A level that no labelled document has counts as the nearest lower one (from 1)
that some have; if there is none, its evidence is taken for the log odds that it is.  Features come from one half of the labelled rows and the shares from
the other half.  Fitting uses about ``LABELLED_ROWS`` labelled rows at the most.

*Rates*.  Least squares ``|A r - target|^2`` in the metric of the domains' token
covariance, from r = 1: each step is r <- max(0, r - posterior . step), where step
is that covariance's inverse times the misfit, so a step of length one is safe and
the rates move no further than needed.  A document's rate is a fold over the steps
so far, so the state of the descent is one small vector per step: no
per-document state is rewritten, and each step is one aggregate over the stored
posteriors.

Only DataFrame expressions run on the executors.

Defined cases: a null or empty text has no tokens; its rate follows from its
posterior and moves no total.  Without labelled rows every document is
``good`` with certainty.  A domain without any expected tokens cannot be raised and is
left out of the fit.  Several labels of one document: toxic counts before
low before good.  Repeated rows are documents of their own.  Extra columns are not
read, and pass through ``resample``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .features import bounded_sample, one_row, words

DOMAINS = ("good", "low", "toxic")
#: Wanted shares of the mixture's tokens; the total keeps the expected tokens of ``good``.
WEIGHTS = {"good": 0.985, "low": 0.01, "toxic": 0.005}
LABELLED_ROWS = 20_000
#: Confidence of a feature's odds (standard deviations), and the least log odds that count.
SURE, LEAST_ODDS = 3.0, 2.0
#: Evidence from which the levels 1, 2 and 3 begin.
LEVELS = (2.0, 4.0, 8.0)
MOST_STEPS, TOLERANCE = 60, 1e-6


def features(w: Column) -> Column:
    """Distinct 64-bit hashes of the features of a word array column."""
    same = F.size(F.filter(F.transform(w, lambda x, i: F.get(w, i - 1) == x), lambda x: F.coalesce(x, F.lit(False))))
    own = F.flatten(F.transform(w, lambda x: F.array(F.xxhash64(F.lower(x)), F.xxhash64(F.substring(x, -3, 3), F.lit(1)))))
    tenth = F.floor(10 * same / F.greatest(F.lit(1), F.size(w))).cast("int")
    return F.array_distinct(F.concat(own, F.array(F.xxhash64(tenth, F.lit(2)))))


@dataclass
class Classifier:
    """``keys``: the hashes of the kept features; ``odds``: per domain their weights; ``shares``: levels -> posterior."""

    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    odds: dict[str, np.ndarray] = field(default_factory=dict)
    shares: dict[int, list[float]] = field(default_factory=dict)
    other: tuple[float, ...] = (1.0, 0.0, 0.0)
    coarser: dict[int, list[float]] = field(default_factory=dict)

    def table(self) -> pa.Array:
        """The features with their weights, listed by slot (the hash modulo the number of slots)."""
        slots = 16
        while slots < 2 * len(self.keys):
            slots *= 2
        slot = np.mod(self.keys, slots)
        order = np.argsort(slot, kind="stable")
        begin = np.concatenate([[0], np.cumsum(np.bincount(slot, minlength=slots))])
        rows = pa.StructArray.from_arrays([pa.array(self.keys[order]), *(pa.array(self.odds[d][order]) for d in DOMAINS)], names=["h", *DOMAINS])
        return pa.ListArray.from_arrays(pa.array(begin, pa.int32()), rows)

    def cells(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``cell`` in place of the feature array ``f``: the levels as one number, a digit per domain."""
        if not self.odds:
            return rows.withColumn("cell", F.lit(0)).drop("f")
        table = self.table()
        at = lambda h: F.get(F.col("_table"), F.pmod(h, F.lit(len(table))).cast("int"))
        plus = lambda a, e: F.struct(*((a[d] + e[d]).alias(d) for d in DOMAINS))
        none = F.struct(*(F.lit(0.0).alias(d) for d in DOMAINS))
        total = F.aggregate("f", none, lambda a, h: F.aggregate(at(h), a, lambda b, e: F.when(e["h"] == h, plus(b, e)).otherwise(b)))
        kept = [c for c in rows.columns if c != "f"]
        cell = F.lit(0)
        for d in DOMAINS:
            cell = cell * (len(LEVELS) + 1) + sum((F.col("_total")[d] >= x).cast("int") for x in LEVELS)
        return (rows.select("*", one_row(rows.sparkSession, table).alias("_table")).select(*kept, total.alias("_total"))
                .select(*kept, cell.alias("cell")))

    def posterior(self, cell: Column) -> list[Column]:
        """Per domain, the share among labelled documents with the same levels, or what ``coarser`` says."""
        if not self.odds:
            return [F.lit(float(x)) for x in self.other]
        shares = [self.shares.get(c) or self.coarser.get(c, self.other) for c in range((len(LEVELS) + 1) ** len(DOMAINS))]
        return [F.get(F.array(*(F.lit(float(s[k])) for s in shares)), cell) for k in range(len(DOMAINS))]


def fit(documents: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> Classifier:
    """Learn from the labelled rows among ``documents``."""
    domain = F.when(F.max("toxic") == 1, "toxic").when(F.min("quality") == 0, "low").when(F.max("quality") == 1, "good")
    named = (labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(domain.alias("domain")).filter("domain is not null"))
    half = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(2)) == 0
    known = stored(documents.select("doc_id", "text").join(F.broadcast(bounded_sample(named, rows)), "doc_id")
                   .select("doc_id", "domain", words(F.col("text")).alias("w"))
                   .select("domain", half.alias("first_half"), features(F.col("w")).alias("f")), "mixing-labelled")
    sizes = {r[0]: r[1] for r in known.filter("first_half").groupBy("domain").count().collect()}
    if not sizes:
        return Classifier()
    everyone = sum(sizes.values())
    counts = (known.filter("first_half").select("domain", F.explode("f").alias("h")).groupBy("h")
              .agg(*(F.count(F.when(F.col("domain") == d, 1)).cast("double").alias(d) for d in DOMAINS)))
    odds = []
    for d in DOMAINS:
        n, rest = float(sizes.get(d, 0)), float(everyone - sizes.get(d, 0))
        a, b = F.col(d), sum(F.col(x) for x in DOMAINS if x != d)
        low, high = a - SURE * F.sqrt(a), b + SURE * F.sqrt(b) + SURE * SURE / 2
        sure = F.when(low > 0, F.ln(low / max(1.0, n)) - F.ln(high / max(1.0, rest))) if n and rest else F.lit(None)
        odds.append(F.when(sure >= LEAST_ODDS, sure).otherwise(0.0).alias(f"o_{d}"))
    best = F.greatest(*(F.col(f"o_{d}") for d in DOMAINS))
    kept = counts.select("h", *odds).filter(best > 0).orderBy("h").toArrow()  # at least ten rows have each
    out = Classifier(kept.column("h").to_numpy(), {d: kept.column(f"o_{d}").to_numpy() for d in DOMAINS})
    cells: dict[int, np.ndarray] = {}
    table = out.cells(known.filter("not first_half").select("domain", "f")).groupBy("cell", "domain").count().collect()
    for cell, d, n in table:
        cells.setdefault(cell, np.zeros(len(DOMAINS)))[DOMAINS.index(d)] += n
    whole = sum(cells.values()) if cells else np.array([float(sizes.get(d, 0)) for d in DOMAINS])
    out.other = tuple(whole / whole.sum())
    out.shares = {c: list(n / n.sum()) for c, n in cells.items()}
    out.coarser = _coarser(cells, np.array([float(sizes.get(d, 0)) for d in DOMAINS]) if not cells else whole)
    return out


def _digits(cell: int) -> list[int]:
    """The level of each domain."""
    return [cell // (len(LEVELS) + 1) ** k % (len(LEVELS) + 1) for k in reversed(range(len(DOMAINS)))]


def _coarser(cells: dict[int, np.ndarray], whole: np.ndarray) -> dict[int, list[float]]:
    """The posterior of every cell from one domain's levels at a time; ``whole``: labelled rows per domain."""
    levels = len(LEVELS) + 1
    seen = np.zeros((len(DOMAINS), levels, len(DOMAINS)))  # evidence for, level, domain of the row
    for cell, n in cells.items():
        for k, x in enumerate(_digits(cell)):
            seen[k, x] += n
    factor = np.ones_like(seen)
    for k in range(len(DOMAINS)):
        for x in range(levels):
            if seen[k, x].any() or not x:
                factor[k, x] = (seen[k, x] + 0.5) / (whole + 0.5 * levels)
            elif seen[k, 1:x].any():
                factor[k, x] = factor[k, x - 1]
            else:
                factor[k, x, k] = np.exp(LEVELS[x - 1])
    out = {}
    for cell in range(levels ** len(DOMAINS)):
        p = whole / max(1.0, whole.sum())
        for k, x in enumerate(_digits(cell)):
            p = p * factor[k, x]
        out[cell] = list(p / p.sum()) if p.sum() else list(whole / max(1.0, whole.sum()))
    return out


def memberships(documents: DataFrame, model: Classifier, *keep: str) -> DataFrame:
    """doc_id, ``keep``, n_tokens and p_<domain> of every row."""
    posterior = [p.alias(f"p_{d}") for d, p in zip(DOMAINS, model.posterior(F.col("cell")))]
    rows = (documents.select("doc_id", *keep, words(F.col("text")).alias("w"))
            .select("doc_id", *keep, F.size("w").cast("long").alias("n_tokens"), features(F.col("w")).alias("f")))
    return model.cells(rows).select("doc_id", *keep, "n_tokens", *posterior)


def rate(steps: list[np.ndarray]) -> Column:
    """The rate after the given steps, of a row with columns p_<domain>."""
    if not steps:
        return F.lit(1.0)
    path = F.array(*(F.array(*(F.lit(float(x)) for x in s)) for s in steps))
    along = lambda r, s: F.greatest(F.lit(0.0), r - sum(s[k] * F.col(f"p_{d}") for k, d in enumerate(DOMAINS)))
    return F.aggregate(path, F.lit(1.0), along)


def fit_rates(members: DataFrame, weights: dict[str, float] | None = None) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(steps, expected totals reached, targets) for stored ``members``."""
    weights = WEIGHTS if weights is None else weights
    p = [F.col(f"p_{d}") for d in DOMAINS]
    n = F.col("n_tokens").cast("double")
    row = members.agg(*(F.coalesce(F.sum(n * p[j] * p[k]), F.lit(0.0)) for j in range(len(p)) for k in range(len(p))),
                      *(F.coalesce(F.sum(n * x), F.lit(0.0)) for x in p)).first()
    size = len(DOMAINS)
    covariance, reached = np.array(row[:size * size]).reshape(size, size), np.array(row[size * size:])
    share = np.array([weights.get(d, 0.0) for d in DOMAINS])
    target = share * (reached[0] / share[0] if share[0] > 0 else reached.sum()) / (1.0 if share[0] > 0 else share.sum())
    target = np.where(reached > 0, target, 0.0)
    inverse, steps = np.linalg.pinv(covariance), []
    for _ in range(MOST_STEPS):
        if np.abs(reached - target).max() <= TOLERANCE * max(1.0, target.sum()):
            break
        steps.append(inverse @ (reached - target))
        got = members.agg(*(F.coalesce(F.sum(n * x * rate(steps)), F.lit(0.0)) for x in p)).first()
        before, reached = reached, np.array(tuple(got))
        if np.abs(reached - before).max() <= TOLERANCE * max(1.0, target.sum()):
            break  # no rates can come nearer
    return steps, reached, target


def rates(documents: DataFrame, labels: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """One row per document: doc_id, n_tokens, p_<domain>, rate."""
    members = stored(memberships(documents, fit(documents, labels)), "mixing-members")
    steps, _, _ = fit_rates(members, weights)
    return members.withColumn("rate", rate(steps))


def resample(documents: DataFrame, labels: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """The rows of ``documents`` as often as their rate says: the whole part, and the rest by a hash of the row."""
    named = documents.select(F.struct("*").alias("row"), "doc_id", "text")
    members = stored(memberships(named, fit(documents, labels), "row"), "mixing-rows")
    steps, _, _ = fit_rates(members, weights)
    rated = members.withColumn("rate", rate(steps))
    chance = F.pmod(F.xxhash64("row.doc_id", "row.text", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    copies = F.floor(F.col("rate") + chance).cast("int")
    return (rated.select("row", copies.alias("copies")).filter("copies > 0")
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*"))
