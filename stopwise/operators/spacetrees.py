"""Half-space trees: scores of a stream, window by window.

A row is scored with the masses of the last full window before it and counted
into its own window afterwards; its rank is taken among the scores of one window
up to it. So the rows of window ``w`` only need the rows of the two windows
before: a Spark group of a few windows and the two before them has a fixed
largest size, whatever the length of the stream. Settings that share a window
size are scored and ranked in the same group, so the rows are shuffled once for
each window size. Inside a group the trees are walked with numpy for all rows at
once; a relational form would shuffle one row per row and tree instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopwise.config import DetectorConfig
from stopwise.operators.thresholds import smaller_in_window

# Share of a feature's range kept free of splits at both ends, and
# share of a window below which a node is not refined further.
SPLIT_PADDING = 0.15
SMALL_MASS = 0.1


@lru_cache(maxsize=64)
def build_trees(
    n_trees: int, height: int, n_features: int, seed: int, lower: float, upper: float
) -> tuple[np.ndarray, np.ndarray]:
    """Feature and split value of each inner node, as ``(tree, node)`` arrays.

    Nodes are numbered like a heap from 1. Each node halves its part of the
    space at a random place of a random feature, drawn by the width it has left.
    """
    inner = 1 << height
    feature = np.zeros((n_trees, inner), dtype=np.int32)
    split = np.zeros((n_trees, inner), dtype=np.float64)
    for t in range(n_trees):
        rng = np.random.default_rng([seed, t])
        low = np.full((1, n_features), float(lower))
        high = np.full((1, n_features), float(upper))
        for depth in range(height):
            first = 1 << depth
            n = first
            width = high - low
            # Draw a feature per node by cumulated width.
            share = np.cumsum(width, axis=1)
            pick = (share < rng.random(n)[:, None] * share[:, -1:]).sum(axis=1)
            rows = np.arange(n)
            a, w = low[rows, pick], width[rows, pick]
            at = a + w * (SPLIT_PADDING + (1 - 2 * SPLIT_PADDING) * rng.random(n))
            feature[t, first : 2 * first] = pick
            split[t, first : 2 * first] = at
            low, high = np.repeat(low, 2, axis=0), np.repeat(high, 2, axis=0)
            high[2 * rows, pick] = at
            low[2 * rows + 1, pick] = at
    return feature, split


def _leaves(x: np.ndarray, feature: np.ndarray, split: np.ndarray, height: int) -> np.ndarray:
    """Leaf place (0-based) of every row in every tree."""
    n_trees = feature.shape[0]
    node = np.ones((len(x), n_trees), dtype=np.int64)
    tree = np.arange(n_trees)
    row = np.arange(len(x))[:, None]
    for _ in range(height):
        node = 2 * node + (x[row, feature[tree, node]] >= split[tree, node])
    return node - (1 << height)


def _leaf_values(leaves: np.ndarray, height: int, window_size: int) -> np.ndarray:
    """What each leaf of each tree adds to a row's raw score, from one window's rows.

    On its way down a row adds ``mass * 2**depth`` per node, up to and with the
    first node of small mass.
    """
    n_leaves = 1 << height
    n_trees = leaves.shape[1]
    flat = leaves + np.arange(n_trees) * n_leaves
    mass = np.bincount(flat.ravel(), minlength=n_trees * n_leaves).reshape(n_trees, n_leaves)
    levels = [mass]
    for _ in range(height):
        mass = mass[:, 0::2] + mass[:, 1::2]
        levels.append(mass)
    value = np.zeros((n_trees, 1))
    going = np.ones((n_trees, 1), dtype=bool)
    for depth, mass in enumerate(reversed(levels)):
        if depth:
            value, going = np.repeat(value, 2, axis=1), np.repeat(going, 2, axis=1)
        value = value + np.where(going, mass * float(2**depth), 0.0)
        going = going & (mass >= SMALL_MASS * window_size)
    return value


# Rows walked at once, so that the row x tree arrays stay small.
_SLICE = 4096


def _sliced(n: int) -> list[slice]:
    return [slice(i, i + _SLICE) for i in range(0, n, _SLICE)]


class _Walk:
    """The leaves that rows of a few windows reach, for all settings that share their trees.

    Trees are drawn one by one from the seed, so settings that only differ in the number of trees walk the same ones:
    the first of the most.
    """

    def __init__(self, cfgs: Sequence[DetectorConfig], n_features: int) -> None:
        most = max(cfgs, key=lambda c: c.n_trees)
        self.height = most.height
        self.feature, self.split = build_trees(
            most.n_trees, most.height, n_features, most.seed, most.lower, most.upper
        )
        self.uses = [np.flatnonzero((self.feature[:, 1:] == f).any(axis=1)) for f in range(n_features)]

    def leaves(self, x: np.ndarray) -> np.ndarray:
        parts = [_leaves(x[i], self.feature, self.split, self.height) for i in _sliced(len(x))]
        return np.concatenate([np.empty((0, len(self.feature)), np.int64), *parts])

    def without(self, x: np.ndarray, leaves: np.ndarray, f: int) -> np.ndarray:
        """The leaves with feature ``f`` set to zero: only trees that split on it are walked again."""
        zeroed, out, again = x.copy(), leaves.copy(), self.uses[f]
        zeroed[:, f] = 0.0
        out[:, again] = _leaves(zeroed, self.feature[again], self.split[again], self.height)
        return out


def _family(cfg: DetectorConfig) -> tuple:
    return cfg.height, cfg.seed, cfg.lower, cfg.upper


def _raw_scores(leaves: np.ndarray, values: np.ndarray, cfg: DetectorConfig) -> np.ndarray:
    raw = [values[np.arange(cfg.n_trees), leaves[i, : cfg.n_trees]].sum(axis=1) for i in _sliced(len(leaves))]
    whole = cfg.n_trees * cfg.window_size * (2.0 ** (cfg.height + 1) - 1)
    return 1.0 - np.concatenate([np.empty(0), *raw]) / whole


def _score_window(
    x: np.ndarray, leaves: np.ndarray, earlier: np.ndarray, walk: _Walk, cfg: DetectorConfig, marked: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Scores of a window's rows and, for the places ``marked``, the change per zeroed feature."""
    changes = np.zeros((len(marked), x.shape[1]))
    if len(earlier) < cfg.window_size:
        return np.zeros(len(x)), changes
    values = _leaf_values(earlier[:, : cfg.n_trees], cfg.height, cfg.window_size)
    scores = _raw_scores(leaves, values, cfg)
    for part in _sliced(len(marked)):
        chosen = marked[part]
        for f in range(x.shape[1]):
            moved = walk.without(x[chosen], leaves[chosen], f)
            changes[part, f] = scores[chosen] - _raw_scores(moved, values, cfg)
    return scores, changes


# Rows a group aims at; a window larger than this makes a group of its own.
GROUP_ROWS = 30_000


def windows_per_group(window_size: int) -> int:
    return max(1, GROUP_ROWS // window_size)


def spread_windows(rows: DataFrame, window_size: int) -> DataFrame:
    """Add ``_window``, ``_group`` and ``_own``; a group also gets the two windows before it.

    A group takes several small windows or one large one, so it never holds more
    than ``max(GROUP_ROWS, window_size) + 2 * window_size`` rows.
    """
    together = windows_per_group(window_size)
    window = F.floor((F.col("seq") - 1) / window_size).cast("long")
    placed = rows.withColumn("_window", window)
    homes = [F.floor((F.col("_window") + k) / together).cast("long") for k in range(3)]
    return placed.withColumn("_group", F.explode(F.array_distinct(F.array(*homes)))).withColumn(
        "_own", F.col("_group") == homes[0]
    )


def score_windows(
    rows: DataFrame,
    features: Sequence[str],
    stream: Sequence[str],
    keys: Sequence[str],
    cfgs: dict[str, DetectorConfig],
    explain: Column | None = None,
) -> DataFrame:
    """``anomaly_score`` and ``n_smaller`` (and ``changes``) of rows numbered by ``seq`` within ``stream``.

    ``cfgs``: settings by ``structure_id``; the result has every row under each. ``n_smaller`` is the number of smaller
    scores among the ``window_size`` up to the row. All settings of one window size share one shuffle of the rows.
    """
    passed = [*stream, *keys, "seq"]
    taken = rows.select(
        *passed,
        (explain if explain is not None else F.lit(False)).alias("_explain"),
        F.array(*[F.col(f).cast("double") for f in features]).alias("_x"),
    )
    fields = [
        *taken.select(*passed).schema,
        T.StructField("structure_id", T.StringType()),
        T.StructField("anomaly_score", T.DoubleType()),
        T.StructField("n_smaller", T.LongType()),
    ]
    if explain is not None:
        fields.append(T.StructField("changes", T.ArrayType(T.DoubleType())))
    out = None
    for size in sorted({c.window_size for c in cfgs.values()}):
        alike = {s: c for s, c in cfgs.items() if c.window_size == size}
        run = _group_scores(alike, size, passed, explain is not None)
        scored = spread_windows(taken, size).groupBy(*stream, "_group").applyInPandas(run, T.StructType(fields))
        out = scored if out is None else out.unionByName(scored)
    return out


def _group_scores(cfgs: dict[str, DetectorConfig], size: int, passed: Sequence[str], explained: bool):
    """The step that scores and ranks a group's own rows under all ``cfgs`` of window size ``size``."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        rows = group.sort_values("seq")
        own = rows["_own"].to_numpy(dtype=bool)
        columns = [*passed, "structure_id", "anomaly_score", "n_smaller", *(["changes"] if explained else [])]
        if not own.any():
            return pd.DataFrame({c: pd.Series(dtype=object) for c in columns})
        x = np.stack(rows["_x"].to_numpy())
        window, marked = rows["_window"].to_numpy(), rows["_explain"].to_numpy(dtype=bool) & own
        names, starts = np.unique(window, return_index=True)
        spans = dict(zip(names.tolist(), map(slice, starts, [*starts[1:], len(rows)])))
        first = int(window[own].min()) - 1  # the window before is scored too, for the ranks
        ranked = window >= first
        scores, ranks, changes, names_of = [], [], [], []
        for family in dict.fromkeys(map(_family, cfgs.values())):
            members = {s: c for s, c in cfgs.items() if _family(c) == family}
            walk = _Walk(list(members.values()), x.shape[1])
            leaves = walk.leaves(x)
            for sid, cfg in members.items():
                score, change = np.zeros(len(rows)), np.empty(len(rows), dtype=object)
                for w, span in spans.items():
                    if w < first:
                        continue
                    before = leaves[spans[w - 1]] if w - 1 in spans else leaves[:0]
                    places = np.flatnonzero(marked[span])
                    score[span], moved = _score_window(x[span], leaves[span], before, walk, cfg, places)
                    for place, values in zip(places + span.start, moved):
                        change[place] = values
                smaller = np.zeros(len(rows), dtype=np.int64)
                smaller[ranked] = smaller_in_window(score[ranked], size)
                names_of += [sid] * int(own.sum())
                scores.append(score[own]), ranks.append(smaller[own]), changes.append(change[own])
        base = rows.loc[own, list(passed)]
        out = {c: np.tile(base[c].to_numpy(), len(cfgs)) for c in passed}
        out |= {"structure_id": names_of, "anomaly_score": np.concatenate(scores), "n_smaller": np.concatenate(ranks)}
        if explained:
            out["changes"] = np.concatenate(changes)
        return pd.DataFrame({c: pd.Series(v, dtype=None if np.asarray(v).dtype.kind in "bif" else object) for c, v in out.items()})[columns]

    return run


def top_changes(features: Sequence[str], n: int = 3) -> Column:
    """The ``n`` features whose removal moves the score most, from ``changes``."""
    named = F.arrays_zip(
        F.array(*[F.lit(f) for f in features]).alias("feature"),
        F.col("changes").alias("contribution"),
        F.sequence(F.lit(0), F.lit(len(features) - 1)).alias("place"),
    )
    ranked = F.array_sort(
        F.transform(
            named,
            lambda c: F.struct(
                (-F.abs(c["contribution"])).alias("rank"),
                c["place"].alias("place"),
                c["feature"].alias("feature"),
                c["contribution"].alias("contribution"),
            ),
        )
    )
    return F.transform(
        F.slice(ranked, 1, n), lambda c: F.struct(c["feature"], c["contribution"])
    )


def top_changes_json(top: str | Column) -> Column:
    """``[["feature", contribution], ...]`` as text."""
    top = F.col(top) if isinstance(top, str) else top
    pairs = F.transform(
        top,
        lambda c: F.concat(
            F.lit('["'), c["feature"], F.lit('", '), c["contribution"].cast("string"), F.lit("]")
        ),
    )
    return F.when(top.isNotNull(), F.concat(F.lit("["), F.array_join(pairs, ", "), F.lit("]")))
