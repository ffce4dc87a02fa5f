"""Boosted models of a class or a number, tuned over a grid with folds."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import cached_property
from itertools import chain, product
from math import fsum

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight import fixed_values as fv
from wardlight.functions.columns import encode
from wardlight.functions.exact import mean
from wardlight.ml.boosting import BINS, Columns, Settings, Tree, boosted_alike, fewest_rows, fit_rows, fit_table
from wardlight.ml.split import with_folds
from wardlight.operators.joins import join_dim
from wardlight.operators.ranking import positions_of_counts
from wardlight.workspace import cores_of_an_executor, stage

#: Tables of up to so many rows are handed whole to the tasks that fit; larger ones stay in Spark. The trees are the same.
TASK_ROWS = 6_000_000
#: Rows that are worth a process of their own in a fit that is alone.
_STRIPE_ROWS = 50_000
_SCORED_ROWS = 1024

NODES = ("round int, tree int, node int, feature int, threshold double, left int, right int, value double, rows bigint")


def label_index(df: DataFrame, c: str, out: str) -> DataFrame:
    """Alphabetical position of each value of a text column, from 0; NULL stays NULL."""
    values = df.select(c).dropna().distinct().withColumn("n", F.lit(1).cast("long"))
    index = positions_of_counts(values, c).select(c, F.col("n_before").cast("int").alias(out))
    return join_dim(df, index, c)


def class_labels(df: DataFrame, c: str) -> list[str]:
    """The classes of a target in alphabetical order; a round grows a tree for each, so they are few."""
    return sorted(r[0] for r in df.select(c).dropna().distinct().collect())


def _vector(features: Sequence[str]) -> Column:
    return F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in features])


class Model:
    """An ensemble as a table of nodes, a row of which leads to its children by `value of feature <= threshold`.

    Nodes of a tree are numbered from 0, its root; -1 as feature is a leaf. NULL and NaN count as above every threshold.
    """

    def __init__(self, features: Sequence[str], base: Sequence[float], nodes: pa.Table, labels: Sequence[str] | None = None):
        self.features, self.base, self.labels = list(features), [float(b) for b in base], None if labels is None else list(labels)
        self.nodes = nodes.sort_by([("round", "ascending"), ("tree", "ascending"), ("node", "ascending")])
        column = lambda c: np.asarray(self.nodes[c].combine_chunks())
        self.roots = np.flatnonzero(column("node") == 0)
        sizes = np.diff(np.append(self.roots, len(nodes)))
        start = np.repeat(self.roots, sizes)
        self.tree_class = column("tree")[self.roots]
        self.feature, self.threshold, self.value, self.rows = (column(c) for c in ("feature", "threshold", "value", "rows"))
        self.left, self.right = column("left") + start, column("right") + start

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Sum of leaf values for each row and class (one column for a number)."""
        out = np.tile(self.base, (len(x), 1))
        for k in range(0, len(x), _SCORED_ROWS):
            part = x[k:k + _SCORED_ROWS]
            node = np.tile(self.roots, (len(part), 1))
            while (inner := self.feature[node] >= 0).any():
                value = np.take_along_axis(part, np.maximum(self.feature[node], 0), axis=1)
                node = np.where(inner, np.where(value <= self.threshold[node], self.left[node], self.right[node]), node)
            for c in range(len(self.base)):
                out[k:k + _SCORED_ROWS, c] += self.value[node[:, self.tree_class == c]].sum(axis=1)
        return out

    def margin_column(self) -> Column:
        """The margins of a row, from its features."""
        width = len(self.features)

        @F.arrow_udf("array<double>")
        def of(x: pa.Array) -> pa.Array:
            found = self.margins(np.asarray(x.flatten()).reshape(-1, width))
            return pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]), pa.array(found.ravel()))
        return of(_vector(self.features))

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds `predicted_quality`, or `probabilities`, `predicted_index` and `predicted_label`; ties go to the first class."""
        if self.labels is None:
            return df.withColumn("predicted_quality", self.margin_column()[0])
        top = F.array_max("_margins")
        grown = df.withColumn("_margins", self.margin_column()).withColumn(
            "_grown", F.transform("_margins", lambda m: F.exp(m - top)))
        total = F.aggregate("_grown", F.lit(0.0), lambda a, b: a + b)
        shares = F.transform("_grown", lambda e: e / total)
        best = F.array_position("_margins", top).cast("int")
        return grown.select(*df.columns, shares.alias("probabilities"), (best - 1).alias("predicted_index"),
                            F.element_at(F.lit(self.labels), best).alias("predicted_label"))

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(self.nodes.to_pandas(), NODES).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        meta = json.dumps({"features": self.features, "base": self.base, "labels": self.labels})
        spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Model":
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        return Model(meta["features"], meta["base"], spark.read.schema(NODES).parquet(f"{path}/nodes").toArrow(), meta["labels"])


@dataclass
class Fitted:
    """A model, the settings chosen, their mean score over the folds, and the scores of all settings tried."""
    model: Model
    best: dict = field(default_factory=dict)
    score: float | None = None
    scores: list[tuple[dict, float]] = field(default_factory=list)


@dataclass
class Prepared:
    """Binned rows (codes, target, mark, fold), the upper ends of the bins, and how a target became `target`."""
    table: DataFrame
    edges: list[np.ndarray]
    classes: int
    base: float = 0.0
    scale: float = 1.0

    @cached_property
    def at_hand(self) -> Broadcast:
        """Rows for the tasks that fit, collected and sent once for all fits."""
        return self.table.sparkSession.sparkContext.broadcast(_rows_at_hand(self.table, len(self.edges)))


def bin_edges(df: DataFrame, features: Sequence[str]) -> list[np.ndarray]:
    """Upper ends of the bins of each feature but the last: distinct approximate quantiles, at most `BINS` - 1."""
    ends = [k / BINS for k in range(1, BINS)]
    return [np.unique(np.array(q, float)) for q in df.select(*[F.col(c).cast("double") for c in features])
            .approxQuantile(list(features), ends, 1 / (8 * BINS))]


def binned(edges: Sequence[np.ndarray]):
    @F.arrow_udf("array<int>")
    def of(x: pa.Array) -> pa.Array:
        values = np.asarray(x.flatten()).reshape(-1, len(edges))
        codes = np.stack([np.searchsorted(e, values[:, k]) for k, e in enumerate(edges)], axis=1).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(codes) + 1, dtype=np.int32) * len(edges)), pa.array(codes.ravel()))
    return of


def prepare(df: DataFrame, features: Sequence[str], key: str, target: Column, classes: int, fold: Column | None = None,
            kept: Mapping[str, str] | None = None) -> Prepared:
    """`kept` names further columns of the table and what they are taken from."""
    edges, base, scale = bin_edges(df, features), 0.0, 1.0
    if not classes:
        base = df.agg(mean(target)).first()[0] or 0.0
        scale = df.agg(F.max(F.abs(target - base))).first()[0] or 1.0
        target = (target - base) / scale
    rows = df.select(binned(edges)(_vector(features)).alias("codes"), target.cast("double").alias("target"),
                     F.xxhash64(F.col(key).cast("string")).alias("mark"), (F.lit(-1) if fold is None else fold).cast("int").alias("fold"),
                     *[F.col(source).alias(name) for name, source in (kept or {}).items()])
    return Prepared(stage(rows.where("target is not null"), "training-rows"), edges, classes, base, scale)


# ---- fits ------------------------------------------------------------------

def _f1(truth: np.ndarray, guess: np.ndarray) -> float:
    """Unweighted mean of the F1 of all classes that occur."""
    return float(np.mean([2 * ((truth == c) & (guess == c)).sum() / ((truth == c).sum() + (guess == c).sum())
                          for c in np.union1d(truth, guess)]))


def _score(margins: np.ndarray, target: np.ndarray, classes: int) -> float:
    return _f1(target, margins.argmax(axis=1)) if classes else -float(np.sqrt(np.mean((margins[:, 0] - target) ** 2)))


@dataclass
class AtHand:
    """Rows of a table in order of fold, the first row of each fold and the end, and the targets and marks."""
    columns: Columns
    target: np.ndarray
    mark: np.ndarray
    ends: np.ndarray


def _trials(rows: AtHand, family: Mapping[Settings, Sequence[int]], held: int) -> Iterator[tuple[Settings, int, float]]:
    """(settings, rounds, score on the fold held out) of settings that differ in `min_child_samples`, each after its rounds."""
    begin, end = rows.ends[held:held + 2]
    train, classes = (rows.target[:begin], rows.target[end:]), next(iter(family)).classes
    shift = 0.0 if classes else fsum(chain(*train)) / sum(map(len, train))
    for number, fits in enumerate(boosted_alike(rows.columns, rows.target - shift, rows.mark, list(family), (begin, end)), 1):
        for members, _, margins in fits:
            if asked := [s for s in members if number in family[s]]:
                score = _score(margins[:, begin:end].T + shift, rows.target[begin:end], classes)
                yield from ((s, number, score) for s in asked)


def _node_rows(number: int, trees: Sequence[Tree], edges: Sequence[np.ndarray], scale: float) -> list[tuple]:
    def threshold(f: int, cut: int) -> float:
        return 0.0 if f < 0 else float(edges[f][cut]) if cut < len(edges[f]) else float("inf")
    return [(number, c, node, int(f), threshold(f, cut), int(left), int(right), float(value) * scale, int(rows))
            for c, t in enumerate(trees)
            for node, (f, cut, left, right, value, rows) in enumerate(zip(t.feature, t.cut, t.left, t.right, t.value, t.rows))]


def _rows_at_hand(table: DataFrame, features: int) -> AtHand:
    """A table of at most `TASK_ROWS` rows."""
    @F.arrow_udf("binary")
    def octets(codes: pa.Array) -> pa.Array:
        own = np.asarray(codes.flatten()).astype(np.uint8)
        ends = np.arange(len(codes) + 1, dtype=np.int32) * features
        return pa.Array.from_buffers(pa.binary(), len(codes), [None, pa.py_buffer(ends), pa.py_buffer(own)])

    found = table.select("target", "mark", "fold", octets("codes").alias("codes")).toArrow()
    target, mark, fold = (np.asarray(found[c].combine_chunks()) for c in ("target", "mark", "fold"))
    codes = np.concatenate([np.frombuffer(part.buffers()[2], np.uint8)[part.offset * features:][:len(part) * features]
                            for part in found["codes"].chunks if len(part)]).reshape(-1, features)
    order = np.argsort(fold, kind="stable")
    return AtHand(Columns(codes[order]), target[order], mark[order], np.searchsorted(fold[order], np.arange(fold.max() + 2)))


def fit_model(rows: Prepared, s: Settings, features: Sequence[str], labels: Sequence[str] | None = None,
              task_rows: int = TASK_ROWS) -> Model:
    """An ensemble on all rows."""
    spark, edges, scale = rows.table.sparkSession, rows.edges, rows.scale
    if (n := rows.table.count()) <= task_rows:
        shared = rows.at_hand
        processes = max(1, min(cores_of_an_executor(spark), n // _STRIPE_ROWS))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                data = shared.value
                for number, trees in enumerate(fit_rows(data.columns, data.target, data.mark, s, processes) if batch.num_rows else ()):
                    columns = zip(*_node_rows(number, trees, edges, scale))
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=NODE_NAMES).cast(NODE_TYPES)
        nodes = spark.range(1).coalesce(1).mapInArrow(run, NODES).toArrow()
    else:
        found = [row for number, trees in enumerate(fit_table(rows.table, len(features), s))
                 for row in _node_rows(number, trees, edges, scale)]
        nodes = pa.table([pa.array(c) for c in zip(*found)], names=NODE_NAMES).cast(NODE_TYPES)
    return Model(features, [rows.base] * max(s.classes, 1) if not s.classes else [0.0] * s.classes, nodes, labels)


NODE_NAMES = [c.split()[0] for c in NODES.split(", ")]
NODE_TYPES = pa.schema([(c.split()[0], {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64()}[c.split()[1]])
                        for c in NODES.split(", ")])


def combinations(grid: Mapping[str, Sequence]) -> list[dict]:
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def grid_scores(rows: Prepared, s: Settings, grid: Mapping[str, Sequence], folds: int, task_rows: int = TASK_ROWS) -> list[tuple[dict, float]]:
    """Every combination of the grid with its mean score over the folds: macro F1, or RMSE of `target` with a minus.

    Combinations that differ in the number of rounds alone are one fit, scored on the way, and so are those that differ in
    `min_child_samples` as long as their trees are the same. Fits of all combinations and folds run side by side, each in a
    task of its own; beyond `task_rows` rows one after the other, over the table.
    """
    options = combinations(grid)
    settings = [replace(s, **o) for o in options]
    rounds: dict[Settings, set[int]] = {}
    for one in settings:
        rounds.setdefault(replace(one, n_estimators=0), set()).add(one.n_estimators)
    families: dict[Settings, dict[Settings, frozenset[int]]] = {}
    for one, asked in rounds.items():
        families.setdefault(replace(one, min_child_samples=0), {})[replace(one, n_estimators=max(asked))] = frozenset(asked)
    fits = [(family, fold) for family in families.values() for fold in range(folds)]
    # the longest begin first
    size = lambda one: (one.max_depth or 0, one.num_leaves or 0, one.n_estimators, one.subsample)
    fits.sort(key=lambda fit: max(map(size, fit[0])), reverse=True)
    if rows.table.count() <= task_rows:
        spark = rows.table.sparkSession
        shared = rows.at_hand

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in batch.column(0).to_pylist():
                    family, fold = fits[i]
                    member = {s: k for k, s in enumerate(family)}
                    found = [(i, member[s], n, x) for s, n, x in _trials(shared.value, family, fold)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*found), (
                        pa.int64(), pa.int32(), pa.int32(), pa.float64()))], names=["fit", "member", "rounds", "score"])
        tried = [(list(fits[i][0])[k], fits[i][1], n, x) for i, k, n, x in spark.range(0, len(fits), 1, len(fits)).mapInArrow(
            run, "fit bigint, member int, rounds int, score double").collect()]
    else:
        tried = [(s, fold, n, x) for family, fold in fits for s, n, x in _trials_over_table(rows, family, fold)]
    by_fold = {(replace(s, n_estimators=n), fold): score for s, fold, n, score in tried}
    return [(o, float(np.mean([by_fold[one, k] for k in range(folds)]))) for o, one in zip(options, settings)]


def _trials_over_table(rows: Prepared, family: Mapping[Settings, Sequence[int]], held: int) -> Iterator[tuple[Settings, int, float]]:
    """As `_trials`, with rows left in Spark. A setting whose trees are others begins anew."""
    left = dict(sorted(family.items(), key=lambda fit: fit[0].min_child_samples))
    while left:
        s, alike = next(iter(left)), dict(left)
        longest = replace(s, n_estimators=max(one.n_estimators for one in left))
        scores = _scores_over_table(rows, longest, frozenset().union(*left.values()), held)
        for number, fewest, score in scores:
            alike = {one: asked for one, asked in alike.items() if one is s or one.min_child_samples <= fewest}
            yield from ((one, number, score) for one, asked in alike.items() if number in asked)
            if number >= max(one.n_estimators for one in alike):
                break
        left = {one: asked for one, asked in left.items() if one not in alike}


def _scores_over_table(rows: Prepared, s: Settings, prefixes: Sequence[int], held: int) -> Iterator[tuple[int, int, float]]:
    """(rounds, rows of the smallest leaf so far, score on the fold held out) at each of `prefixes`."""
    train, test = rows.table.where(F.col("fold") != held), rows.table.where(F.col("fold") == held)
    shift = 0.0 if s.classes else train.agg(mean(F.col("target"))).first()[0]
    features, gathered, fewest = len(rows.edges), [], 1 << 62
    for number, trees in enumerate(fit_table(train.withColumn("target", F.col("target") - shift), features, s), 1):
        gathered.append(trees)
        fewest = min(fewest, fewest_rows(trees))
        if number not in prefixes:
            continue
        grown = list(gathered)

        @F.arrow_udf("array<double>")
        def margins(codes: pa.Array) -> pa.Array:
            own = np.asarray(codes.flatten()).reshape(-1, features)
            out = np.full((len(own), max(s.classes, 1)), shift)
            for trees in grown:
                for c, tree in enumerate(trees):
                    out[:, c] += tree.value[tree.leaf_of(own)]
            return pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1, dtype=np.int32) * out.shape[1]), pa.array(out.ravel()))
        scored = test.select("target", margins("codes").alias("m"))
        if s.classes:
            guess = F.array_position("m", F.array_max("m")).cast("double") - 1
            cells = scored.groupBy("target", guess.alias("guess")).count().collect()  # classes x classes
            n = np.zeros((s.classes, s.classes))
            for t, g, count in cells:
                n[int(t), int(g)] = count
            there = n.sum(0) + n.sum(1)
            yield number, fewest, float(np.mean(2 * np.diag(n)[there > 0] / there[there > 0]))
        else:
            yield number, fewest, -float(np.sqrt(scored.agg(F.avg((F.col("m")[0] - F.col("target")) ** 2)).first()[0]))


def _fit(df: DataFrame, features: Sequence[str], key: str, target: Column, s: Settings, labels: Sequence[str] | None,
         grid: Mapping[str, Sequence] | None, folds: int, strata: str | None, params: Mapping) -> Fitted:
    s = replace(s, **params)
    if not grid:
        return Fitted(fit_model(prepare(df, features, key, target, s.classes), s, features, labels), dict(params))
    if strata is None:
        rows = prepare(with_folds(df, key, folds, out="_fold"), features, key, target, s.classes, F.col("_fold"))
    else:  # rows are put in order by hash once they are binned, so that they are narrow
        rows = prepare(df, features, key, target, s.classes, kept={"_key": key, "_strata": strata})
        parted = with_folds(rows.table.drop("fold"), "_key", folds, strata="_strata")
        rows.table = stage(parted.select("codes", "target", "mark", "fold"), "training-rows")
    scores = [(options, score * (1.0 if s.classes else rows.scale)) for options, score in grid_scores(rows, s, grid, folds)]
    best, score = max(scores, key=lambda x: x[1])
    return Fitted(fit_model(rows, replace(s, **best), features, labels), best, score, scores)


def fit_classifier(df: DataFrame, features: Sequence[str], label: str, key: str, grid: Mapping[str, Sequence] | None = None,
                   folds: int = fv.FOLDS, **params) -> Fitted:
    """Softmax boosting of a text label by trees of limited depth; with a grid, tuned by macro F1 over stratified folds.

    Rows whose label is NULL are left out.
    """
    labels = class_labels(df, label)
    target = encode(label, {v: i for i, v in enumerate(labels)}, None).cast("double")
    s = Settings(len(labels), max_depth=6, learning_rate=0.3, seed=fv.SEED)
    return _fit(df, list(features), key, target, s, labels, grid, folds, label, params)


def fit_regressor(df: DataFrame, features: Sequence[str], target: str, key: str, grid: Mapping[str, Sequence] | None = None,
                  folds: int = fv.FOLDS, **params) -> Fitted:
    """Boosting of a number by trees that grow best leaf first; with a grid, tuned by RMSE over plain folds."""
    s = Settings(0, num_leaves=31, min_child_samples=20, min_child_weight=1e-3, l2=0.0, seed=fv.SEED)
    fitted = _fit(df, list(features), key, F.col(target).cast("double"), s, None, grid, folds, None, params)
    return fitted


def settings_row(fitted: Fitted) -> dict:
    """The chosen settings under the names that reports give them."""
    return {f"best_{name}": value for name, value in fitted.best.items()}
