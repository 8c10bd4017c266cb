"""A forest and a boosted ensemble per symbol and cutoff, for any number of cutoffs in one job.

A symbol's model reads at most 180 rows, so rows meet by (symbol, block of cutoffs): each labeled row is shuffled to the one to
four blocks that need it, not once per cutoff. Inside a group all trees of all its models grow together, level by level, from one
histogram keyed by (tree, node, input, bin). Groups are bounded whatever the number of symbols, days or cutoffs. ``training`` keeps the
fits that pool all symbols.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..params import FEATURES, RULES, Rules
from ..session import materialize
from . import series
from .training import ensemble

BINS = 32
BLOCK = 64  # labeled rows whose cutoffs share a group
TOGETHER = 16  # models grown at once, which bounds a task's memory
COLUMNS = ("symbol string, date date, train_rows long, insufficient boolean, rf_prob double, xgb_prob double, rf_accuracy double, "
           "xgb_accuracy double, top_features array<string>")


@dataclass(frozen=True)
class Forest:
    """Trees on bootstrap samples with balanced classes; each node is offered a random set of inputs."""

    trees: int = 50
    depth: int = 6
    least_rows: int = 5
    offered: int = 5  # of 28: the square root
    bootstrap: bool = True


@dataclass(frozen=True)
class Booster:
    """Second-order boosting: leaves -G / (H + l2), splits gain at least gamma, children weigh at least least_weight."""

    rounds: int = 50
    depth: int = 4
    rate: float = 0.05
    l2: float = 5.0
    least_weight: float = 5.0
    gamma: float = 0.5
    rows: float = 0.8
    columns: float = 0.8


FOREST, BOOSTER = Forest(), Booster()


@dataclass
class Fit:
    """One model's data as bins: ``y`` for the fitted rows, which come first; the rows after them are only scored."""

    bins: np.ndarray
    y: np.ndarray
    seed: list[int]

    def generator(self, which: int) -> np.random.Generator:
        return np.random.default_rng([*self.seed, which])


def binned(fit: np.ndarray, other: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Bins of both sets after winsorizing by the fitted one: floor(bins * share of fitted rows that are smaller). Trees see only the
    order of values, so scaling changes nothing here."""
    low, high = np.percentile(fit, [100 * P.WINSOR_LOW, 100 * P.WINSOR_HIGH], axis=0)
    both = np.clip(np.concatenate([fit, other]), low, high)
    inner = np.sort(both[:len(fit)], axis=0)
    below = np.stack([np.searchsorted(inner[:, k], both[:, k]) for k in range(both.shape[1])], axis=1)
    return below * bins // len(fit)


def grow(bins: np.ndarray, row: np.ndarray, tree: np.ndarray, trees: int, stats: np.ndarray, depth: int,
         offered: Callable, gain: Callable, leaf: Callable) -> tuple[np.ndarray, list[tuple]]:
    """Grow all ``trees`` at once; (leaf value of each entry, splits as (tree, place, input, bin, gain) arrays per level).

    An entry is a row of ``bins`` in a tree with its ``stats`` (kinds, entries); entries whose stats are 0 just follow the splits. Per level
    one histogram over (node, input, bin) gives every node's best split: ``gain`` of the sums at and below a bin and in all, gains
    equal to nine digits go to the first input and lowest bin. Nodes without a positive gain are leaves.
    """
    node, live = tree, np.arange(len(row))
    owner, place = np.arange(trees), np.zeros(trees, np.int64)
    out, splits = np.empty(len(row)), []
    for level in range(depth + 1):
        count = len(owner)
        total = np.stack([np.bincount(node, s[live], count) for s in stats])
        split = np.zeros(count, bool)
        if level < depth:
            inputs = offered(owner, place)
            width = inputs.shape[1]
            cell = (node[:, None] * width + np.arange(width)) * BINS + bins[row[live][:, None], inputs[node]]
            sums = np.stack([np.bincount(cell.ravel(), np.repeat(s[live], width), count * width * BINS) for s in stats])
            sums = sums.reshape(len(stats), count, width, BINS).cumsum(axis=3)
            found = np.round(gain(sums, total[:, :, None, None]), 9).reshape(count, -1)
            best = found.argmax(axis=1)
            top = found[np.arange(count), best]
            split = top > 0
        ends = ~split[node]
        out[live[ends]] = leaf(total)[node[ends]]
        if not split.any():
            break
        chosen, edge = inputs[np.arange(count), best // BINS], best % BINS
        splits.append((owner[split], place[split], chosen[split], edge[split], top[split]))
        live, node = live[~ends], node[~ends]
        right = bins[row[live], chosen[node]] > edge[node]
        node = 2 * (np.cumsum(split) - 1)[node] + right
        owner = np.repeat(owner[split], 2)
        place = np.repeat(2 * place[split] + 1, 2)
        place[1::2] += 1
    return out, splits


def _smallest(keys: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` smallest keys of each row, in rising order of place."""
    if k >= keys.shape[1]:
        return np.broadcast_to(np.arange(keys.shape[1]), keys.shape)
    return np.sort(np.argpartition(keys, k - 1, axis=1)[:, :k], axis=1)


def forests(fits: list[Fit], spec: Forest = FOREST) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """(P(up) of each fit's scored rows, importance of each input per fit).

    Classes weigh n / (2 n_class). Importance is the decrease of the Gini impurity, summed to 1 per tree, averaged over trees.
    """
    rows, trees, weights, ups, keys, start = [], [], [], [], [], 0
    inputs = fits[0].bins.shape[1]
    for number, fit in enumerate(fits):
        n, scored = len(fit.y), len(fit.bins) - len(fit.y)
        rng = fit.generator(1)
        times = np.ones((spec.trees, n), np.int64)
        if spec.bootstrap:
            drawn = rng.integers(0, n, (spec.trees, n)) + n * np.arange(spec.trees)[:, None]
            times = np.bincount(drawn.ravel(), minlength=spec.trees * n).reshape(spec.trees, n)
        keys.append(rng.random((spec.trees, 2 ** spec.depth, inputs)) if spec.offered < inputs else np.zeros((spec.trees, 2 ** spec.depth, inputs)))
        t, r = np.nonzero(times)
        each = n / (2 * np.maximum(np.bincount(fit.y, minlength=2), 1))
        rows += [start + r, np.tile(start + n + np.arange(scored), spec.trees)]
        trees += [number * spec.trees + t, np.repeat(number * spec.trees + np.arange(spec.trees), scored)]
        weights += [times[t, r] * each[fit.y[r]], np.zeros(spec.trees * scored)]
        ups += [fit.y[r], np.zeros(spec.trees * scored, np.int64)]
        start += len(fit.bins)
    row, tree, weight, up = (np.concatenate(x) for x in (rows, trees, weights, ups))
    stats = np.stack([weight > 0, weight * (1 - up), weight * up]).astype(float)
    key = np.concatenate(keys)

    def gain(left, total):
        right = total - left
        with np.errstate(divide="ignore", invalid="ignore"):
            parts = [a[1] * a[2] / (a[1] + a[2]) for a in (total, left, right)]
        fits_ = (left[0] >= spec.least_rows) & (right[0] >= spec.least_rows)
        return np.where(fits_, 2 * (parts[0] - parts[1] - parts[2]), -1.0)

    value, splits = grow(np.concatenate([f.bins for f in fits]), row, tree, len(fits) * spec.trees, stats, spec.depth,
                         lambda owner, place: _smallest(key[owner, place], spec.offered), gain,
                         lambda total: total[2] / np.maximum(total[1] + total[2], 1e-300))
    share = np.zeros((len(fits) * spec.trees, inputs))
    for owner, _, chosen, _, top in splits:
        np.add.at(share, (owner, chosen), top)
    share /= np.maximum(share.sum(axis=1, keepdims=True), 1e-300)
    only = weight == 0
    which = row[only]
    mean = np.bincount(which, value[only], start) / spec.trees
    scores, at = [], 0
    for fit in fits:
        scores.append(mean[at + len(fit.y):at + len(fit.bins)])
        at += len(fit.bins)
    return scores, list(share.reshape(len(fits), spec.trees, inputs).mean(axis=1))


def boosters(fits: list[Fit], spec: Booster = BOOSTER) -> list[np.ndarray]:
    """P(up) of each fit's scored rows, from a margin of 0 and ``rounds`` trees on the gradients of the log loss.

    Each tree reads a random share of the rows and a random set of the inputs.
    """
    sizes = np.array([len(f.bins) for f in fits])
    tree = np.repeat(np.arange(len(fits)), sizes)
    bins = np.concatenate([f.bins for f in fits])
    inputs = bins.shape[1]
    kept = max(1, int(spec.columns * inputs))
    y, fitted, drawn, keys = np.zeros(len(tree)), np.zeros(len(tree), bool), np.zeros((spec.rounds, len(tree)), bool), []
    at = 0
    for fit in fits:
        n, rng = len(fit.y), fit.generator(2)
        y[at:at + n], fitted[at:at + n] = fit.y, True
        drawn[:, at:at + n] = rng.random((spec.rounds, n)) < spec.rows
        keys.append(rng.random((spec.rounds, inputs)))
        at += len(fit.bins)
    key, margin, row = np.stack(keys), np.zeros(len(tree)), np.arange(len(tree))

    def gain(left, total):
        right = total - left
        worth = [a[0] ** 2 / np.maximum(a[1] + spec.l2, 1e-300) for a in (left, right, total)]
        found = worth[0] + worth[1] - worth[2]
        allowed = (left[1] >= spec.least_weight) & (right[1] >= spec.least_weight) & (found >= spec.gamma)
        return np.where(allowed, found, -1.0)

    for turn in range(spec.rounds):
        p = 1 / (1 + np.exp(-margin))
        stats = np.stack([p - y, p * (1 - p)]) * drawn[turn]
        offered = _smallest(key[:, turn], kept)
        value, _ = grow(bins, row, tree, len(fits), stats, spec.depth, lambda owner, place, offered=offered: offered[owner], gain,
                        lambda total: -total[0] / np.maximum(total[1] + spec.l2, 1e-300))
        margin += spec.rate * value
    p = 1 / (1 + np.exp(-margin))
    out, at = [], 0
    for fit in fits:
        out.append(p[at + len(fit.y):at + len(fit.bins)])
        at += len(fit.bins)
    return out


def _judged(x: np.ndarray, y: np.ndarray, today: np.ndarray, seed: list[int], rules: Rules) -> list[Fit]:
    """The fit without the newest rows, which are scored for the accuracy, and the fit on all rows, which scores the cutoff's row."""
    h = rules.holdout
    return [Fit(binned(x[:-h], x[-h:]), y[:-h], [*seed, 0]), Fit(binned(x, today[None]), y, [*seed, 1])]


def _accuracy(up: np.ndarray, truth: np.ndarray) -> float:
    return float(np.mean((np.round(up, 9) > 0.5) == truth))


def block_signals(labeled: pd.DataFrame, due: pd.DataFrame, forest: Forest, booster: Booster, rules: Rules, seed: int) -> Iterator[tuple]:
    """Signal rows of one symbol's cutoffs. ``labeled`` has the rows that their windows need."""
    labeled = labeled.sort_values("place")
    place = labeled["place"].to_numpy()
    x, y = labeled[FEATURES].to_numpy(float), labeled["target"].to_numpy().astype(np.int64)
    models = []
    for k in range(len(due)):
        end = np.searchsorted(place, due["seen"].iloc[k], "right")
        models.append((k, max(0, end - rules.train_window), end))
    short = [m for m in models if m[2] - m[1] < rules.min_history]
    names = due["symbol"].tolist(), due["date"].tolist()
    for k, a, b in short:
        yield names[0][k], names[1][k], b - a, True, 0.0, 0.0, 0.0, 0.0, []
    ready = [m for m in models if m[2] - m[1] >= rules.min_history]
    now = due[FEATURES].to_numpy(float)
    for at in range(0, len(ready), TOGETHER):
        part = ready[at:at + TOGETHER]
        fits = [f for k, a, b in part for f in _judged(
            x[a:b], y[a:b], now[k], [seed, zlib.crc32(str(names[0][k]).encode()), names[1][k].toordinal()], rules)]
        up, share = forests(fits, forest)
        boosted = boosters(fits, booster)
        for i, (k, a, b) in enumerate(part):
            truth = y[b - rules.holdout:b]
            top = sorted(range(len(FEATURES)), key=lambda f: (-share[2 * i + 1][f], f))[:5]
            yield (names[0][k], names[1][k], b - a, False, up[2 * i + 1][0], boosted[2 * i + 1][0],
                   _accuracy(up[2 * i], truth), _accuracy(boosted[2 * i], truth), [FEATURES[f] for f in top])


def signals(features: DataFrame, due: DataFrame, forest: Forest = FOREST, booster: Booster = BOOSTER, rules: Rules = RULES,
            seed: int = 42, block: int = BLOCK) -> DataFrame:
    """The signal result of every (symbol, date) of ``due`` that has a row in ``features``: one row each, as ``training.signal_result``
    gives it, with one model pair per symbol and date.

    A model reads the symbol's last 180 labeled rows before the date; fewer than 80 make it ``insufficient``: probabilities and
    accuracies 0, no signal, no top inputs. Draws depend on the seed, the symbol and the date alone, so results do not depend on the
    blocks, the partitions or the other dates. ``features`` is read by several branches: pass a materialized frame.
    """
    rows = features.select("symbol", "date", "target", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in FEATURES])
    counted = materialize(series.running(
        rows.withColumns({"_known": F.col("target").isNotNull().cast("int"), "_year": F.year("date")}), ["symbol"], ["date"], "_year",
        seen=("sum_before", "_known")).drop("_year"))
    # a labeled row is number seen + 1 of its symbol, and a date needs the numbers seen - 179 to seen
    number = F.col("seen") + 1
    needed = F.sequence(F.floor(number / block), F.floor((number + rules.train_window - 1) / block))
    wanted = counted.join(due.select("symbol", "date").distinct(), ["symbol", "date"], "left_semi")
    scored = wanted.select("*", F.floor(F.col("seen") / block).alias("block"), F.lit(True).alias("due"), F.lit(None).cast("long").alias("place"))
    used = scored.select("symbol", "block").distinct()
    fitted = counted.filter("_known = 1").select("*", F.explode(needed).alias("block"), F.lit(False).alias("due"), number.cast("long").alias("place"))
    fitted = fitted.join(used, ["symbol", "block"], "left_semi").select(*scored.columns)
    parts = int(features.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = scored.unionByName(fitted).drop("_known").repartition(parts, "symbol", "block").groupBy("symbol", "block")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        mine = pdf["due"].to_numpy()
        found = list(block_signals(pdf[~mine], pdf[mine], forest, booster, rules, seed))
        return pd.DataFrame(found, columns=[c.split()[0] for c in COLUMNS.split(", ")])

    return ensemble(grouped.applyInPandas(run, COLUMNS), rules)
