"""K-means on whole numbers: fit, evaluate, save, load.

Features become whole units, their moments exact sums, and the standardised values points of a
whole-numbered grid, with the mean of all rows as its origin. Seeds are oversampled by squared
distance: in every round each point's distance from the candidates so far, over a draw that mixes the
point itself, is its priority, and those with the highest join them. The start is the choice of
candidates with the lowest cost over all candidates, each weighing the rows nearest to it. From there
distances are whole numbers and new centres rounded quotients of whole sums, until they come to rest.
Nothing depends on how rows are partitioned or in which order they are added.

A pass reads all points in Arrow batches and returns k rows of sums a task. Most points settle early: where
the second nearest centre is further than the nearest by more than twice a radius, neither can change
while every centre stays within that radius. A full pass sums up such points for good and keeps the
others, and the next steps read only these, until a centre leaves its radius: in one task where a
count has shown them to be few, else in passes of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsieve.operators.cleansing import drop_incomplete
from claimsieve.operators.clusters import CLUSTER, Centroids, assign, inertia, silhouette_squared
from claimsieve.params import DEFAULTS, Params

#: Features are counted in thousandths, standardised values in 4096ths of a deviation.
UNITS = 1000
GRID = 4096
#: Rounds of seeding, candidates a round adds, and choices of k candidates that are all tried; beyond them, one by one.
ROUNDS = 2
SEEDS = 32
CHOICES = 50_000
#: How many times the last step of the centres they may go before points that seemed settled are read again.
REACH = 8.0
#: So many points, of those that may still change, go on in one task; more of them take a pass for each step.
NEAR_ROWS = 2_000_000
#: Values beyond this would take squared distances out of 64 bits.
FURTHEST = 1 << 30
#: Sums of so many values at a time are exact in floating point: the product with FURTHEST is below 2^53.
EXACT_ROWS = 1 << 20
_MODULUS = (1 << 31) - 1
_FACTORS = (73_856_093, 19_349_663, 83_492_791)
_SALT = 15_485_863
_LIMB = 32

Center = tuple[int, ...]
Centers = tuple[Center, ...]


@dataclass(frozen=True)
class Fitted:
    """Centres with their scale, the rows they were trained on, and how many those are."""

    centroids: Centroids
    points: DataFrame
    n_samples: int

    @property
    def pipeline(self) -> PipelineModel:
        return PipelineModel([scoring_stage(self.centroids)])

    def release(self) -> None:
        """Give the memory of the points back; they can still be read, from the rows again."""
        self.points.unpersist()


def _unit(c: str) -> str:
    return f"_u_{c}"


def unit_points(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The features of every row in whole units, and as the numbers these stand for."""
    units = [F.floor(F.col(c) * F.lit(float(UNITS)) + 0.5).cast("bigint").alias(_unit(c)) for c in columns]
    return rows.select(*units).select("*", *[(F.col(_unit(c)).cast("double") / F.lit(float(UNITS))).alias(c) for c in columns])


def _limbs(value: Column, name: str) -> list[Column]:
    """The sum of whole numbers of up to 64 bits, in two sums that stay within them."""
    return [
        F.sum(F.shiftright(value, _LIMB)).alias(f"{name}_high"),
        F.sum(value.bitwiseAND(F.lit((1 << _LIMB) - 1))).alias(f"{name}_low"),
    ]


def _whole(row, name: str) -> int:
    return (int(row[f"{name}_high"] or 0) << _LIMB) + int(row[f"{name}_low"] or 0)


def _moments(points: DataFrame, columns: tuple[str, ...]) -> tuple[int, tuple[float, ...], tuple[float, ...]]:
    """Rows, means and population deviations in units, from exact sums: one row reaches the driver."""
    units = [F.col(_unit(c)) for c in columns]
    sums = [x for i, u in enumerate(units) for x in (*_limbs(u, f"s{i}"), *_limbs(u * u, f"q{i}"))]
    row = points.agg(F.count(F.lit(1)).alias("n"), *sums).first()
    n = int(row["n"])
    if not n:
        return 0, (), ()
    s, q = ([_whole(row, f"{x}{i}") for i in range(len(columns))] for x in "sq")
    means = tuple(float(a) / float(n) for a in s)
    return n, means, tuple(math.sqrt(float(n * b - a * a)) / float(n) for a, b in zip(s, q))


def _grid(columns: tuple[str, ...], means: tuple[float, ...], deviations: tuple[float, ...]) -> list[Column]:
    return [
        F.floor((F.col(_unit(c)).cast("double") - F.lit(m)) / F.lit(s) * F.lit(float(GRID)) + 0.5).cast("bigint")
        if s > 0
        else F.lit(0).cast("bigint")
        for c, m, s in zip(columns, means, deviations)
    ]


def draw(x: np.ndarray, salt: int) -> np.ndarray:
    """A number from 1 to 2^31 - 1 for every point, which mixes its grid values with a salt."""
    mixed = np.full(len(x), salt * _SALT % _MODULUS, np.int64)
    for i in range(x.shape[1]):
        mixed = (mixed + x[:, i] % _MODULUS * (_FACTORS[i % len(_FACTORS)] % _MODULUS)) % _MODULUS
    return mixed * 48_271 % _MODULUS + 1


def _values(part: pa.RecordBatch, d: int) -> np.ndarray:
    x = np.column_stack([part.column(f"x{i}").to_numpy() for i in range(d)])
    if len(x) and np.abs(x).max() > FURTHEST:
        raise ValueError(f"a feature is more than {FURTHEST // GRID} deviations from its mean; scale it first")
    return x


def _squares(x: np.ndarray, centers: Centers) -> np.ndarray:
    columns = [np.ascontiguousarray(x[:, i]) for i in range(x.shape[1])]
    far = np.zeros((len(centers), len(x)), np.int64)
    for row, center in zip(far, centers):
        for column, v in zip(columns, center):
            apart = column - np.int64(v)
            apart *= apart
            row += apart
    return far.T


def _seeds(placed: DataFrame, d: int, centers: Centers, salt: int) -> Centers:
    """The different points of the highest priority: squared distance from the nearest centre, over the draw."""
    names = [f"x{i}" for i in range(d)]

    def first(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        far = _squares(x, centers).min(axis=1)
        x, far = x[far > 0], far[far > 0]
        priority = far.astype(np.float64) / draw(x, salt).astype(np.float64)
        # Equal points have one priority, so as many different priorities as seeds hold all that can be first.
        high = priority >= np.unique(priority)[-SEEDS:][:1]
        x, at = np.unique(x[high], axis=0, return_index=True)
        priority = priority[high][at]
        order = np.lexsort((*x.T[::-1], -priority))[:SEEDS]
        return x[order], priority[order]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.zeros((0, d), np.int64)
        for part in batches:
            best = first(np.concatenate([best, _values(part, d)]))[0]
        x, priority = first(best)
        yield pa.RecordBatch.from_arrays([*(pa.array(x[:, i]) for i in range(d)), pa.array(priority)], [*names, "priority"])

    found = placed.mapInArrow(task, ", ".join(f"{n} long" for n in names) + ", priority double").distinct()
    rows = found.orderBy(F.desc("priority"), *names).limit(SEEDS).collect()
    return tuple(tuple(r[n] for n in names) for r in rows)


def _schema(d: int) -> str:
    sums = ", ".join(f"s{i}_high long, s{i}_low long" for i in range(d))
    return ", ".join(f"x{i} long" for i in range(d)) + f", cluster int, n long, {sums}"


def _sums_and_near(placed: DataFrame, d: int, centers: Centers, radius: float | None) -> DataFrame:
    """Rows with a cluster: the sums of its points, or of the settled ones with a radius. Rows without one: the other points."""
    k, schema = len(centers), _schema(d)
    names = [c.split()[0] for c in schema.split(", ")]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = [0] * k, [[0] * d for _ in range(k)]
        for part in batches:
            x = _values(part, d)
            far = _squares(x, centers)
            own = far.argmin(axis=1)
            if radius is not None and k > 1:
                root = np.sqrt(np.partition(far, 1, axis=1)[:, :2].astype(np.float64))
                near = root[:, 1] - root[:, 0] <= 2 * radius + 1e-3
                columns = [pa.array(x[near, i]) for i in range(d)]
                columns += [pa.nulls(int(near.sum()), pa.int32() if c == "cluster" else pa.int64()) for c in names[d:]]
                yield pa.RecordBatch.from_arrays(columns, names)
                x, own = x[~near], own[~near]
            for at in range(0, len(x), EXACT_ROWS):
                some, whose = x[at : at + EXACT_ROWS], own[at : at + EXACT_ROWS]
                counts = [a + int(b) for a, b in zip(counts, np.bincount(whose, minlength=k))]
                for i in range(d):
                    for j, v in enumerate(np.bincount(whose, some[:, i], minlength=k)):
                        sums[j][i] += int(v)
        for j in range(k):
            whole = [v for s in sums[j] for v in (s >> _LIMB, s & ((1 << _LIMB) - 1))]
            values = [*[None] * d, j, counts[j], *whole]
            kinds = [pa.int32() if c == "cluster" else pa.int64() for c in names]
            yield pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(values, kinds)], names)

    return placed.select(*names[:d]).mapInArrow(task, schema)


Totals = list[tuple[int, list[int]]]


def _totals(rows: DataFrame, d: int, k: int) -> Totals:
    """Rows and sums of every cluster: k rows reach the driver."""
    sums = [F.sum(f"s{i}_{side}").alias(f"s{i}_{side}") for i in range(d) for side in ("high", "low")]
    found: Totals = [(0, [0] * d) for _ in range(k)]
    for r in rows.where("cluster IS NOT NULL").groupBy("cluster").agg(F.sum("n").alias("n"), *sums).collect():
        found[r["cluster"]] = int(r["n"]), [_whole(r, f"s{i}") for i in range(d)]
    return found


def _moved(centers: Centers, *parts: Totals) -> Centers:
    """The rounded mean of every cluster; an empty one stays."""
    after = []
    for j, center in enumerate(centers):
        n = sum(part[j][0] for part in parts)
        whole = [sum(values) for values in zip(*(part[j][1] for part in parts))]
        after.append(tuple((2 * s + n) // (2 * n) for s in whole) if n else center)
    return tuple(after)


def _step(before: Centers, after: Centers) -> float:
    return max(math.dist(a, b) for a, b in zip(before, after))


def _own_totals(x: np.ndarray, centers: Centers) -> Totals:
    own = _squares(x, centers).argmin(axis=1)
    return [(int((own == j).sum()), [int(v) for v in x[own == j].sum(axis=0)]) for j in range(len(centers))]


def _settle(near: DataFrame, d: int, now: Centers, radius: float, settled: Totals, left: int) -> tuple[Centers, int, float]:
    """Steps of the few points that may change beside the settled ones, in one task: the centres, steps left, the last step.

    They end at rest, when no steps are left, or with the step that leaves the radius.
    """
    names = [f"x{i}" for i in range(d)]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = np.concatenate([np.zeros((0, d), np.int64), *(_values(part, d) for part in batches)])
        at, step, steps = now, math.inf, left
        while steps and step > 0 and _step(now, at) <= radius:
            after = _moved(at, settled, _own_totals(x, at))
            at, step, steps = after, _step(at, after), steps - 1
        columns = [pa.array([c[i] for c in at]) for i in range(d)]
        k = len(at)
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(range(k), pa.int32()), pa.array([steps] * k, pa.int32()), pa.array([step] * k)],
            [*names, "cluster", "steps", "step"],
        )

    one = near.where("cluster IS NULL").select(*names).coalesce(1)
    rows = one.mapInArrow(task, ", ".join(f"{n} long" for n in names) + ", cluster int, steps int, step double").collect()  # k rows
    found = sorted(rows, key=lambda r: r["cluster"])
    return tuple(tuple(r[n] for n in names) for r in found), found[0]["steps"], found[0]["step"]


def start(candidates: Centers, weights: list[int], k: int) -> Centers:
    """The k candidates with the lowest cost over all of them, each with its weight; the first such choice in order.

    Beyond CHOICES the candidates are taken one by one, each where it lowers the cost most.
    """
    points, order = np.array(candidates, np.float64), range(len(candidates))
    weighed = ((points[:, None] - points[None]) ** 2).sum(axis=2) * np.array(weights, np.float64)

    def cost(chosen: tuple[int, ...]) -> int:
        near = (min(sum((a - b) ** 2 for a, b in zip(p, candidates[j])) for j in chosen) for p in candidates)
        return sum(w * d for w, d in zip(weights, near))

    def lowest(choices: list[tuple[int, ...]]) -> tuple[int, ...]:
        """Whole numbers decide between what floating point can't tell apart."""
        costs = np.concatenate(
            [weighed[np.array(choices[i : i + 1000])].min(axis=1).sum(axis=1) for i in range(0, len(choices), 1000)]
        )
        close = np.flatnonzero(costs <= costs.min() * (1 + 1e-9))
        return min((choices[i] for i in close), key=lambda c: (cost(c), c))

    if math.comb(len(candidates), k) <= CHOICES:
        return tuple(candidates[j] for j in lowest(list(combinations(order, k))))
    chosen: tuple[int, ...] = ()
    while len(chosen) < k:
        chosen = lowest([(*chosen, j) for j in order if j not in chosen])
    return tuple(candidates[j] for j in sorted(chosen))


def fit(placed: DataFrame, columns: tuple[str, ...], params: Params = DEFAULTS) -> Centers:
    """Centres at rest, or after ``max_iter`` steps, by rising ratio. Fewer different points than clusters repeat a centre."""
    d, k = len(columns), params.n_clusters
    candidates: Centers = ((0,) * d,)
    for turn in range(ROUNDS):
        candidates += _seeds(placed, d, candidates, params.seed + turn)
    candidates = tuple(sorted(candidates))
    weights = [n for n, _ in _totals(_sums_and_near(placed, d, candidates, None), d, len(candidates))]
    candidates += candidates[-1:] * (k - len(candidates))
    weights += [0] * (len(candidates) - len(weights))
    now = start(candidates, weights, k)
    step, left, near, base, radius = math.inf, params.max_iter, None, now, -1.0
    n_rows = sum(weights)
    try:
        while left and step > 0:
            if math.isinf(step):  # a first step tells how far steps go
                after = _moved(now, _totals(_sums_and_near(placed, d, now, None), d, k))
            else:
                if near is None or _step(base, now) > radius:
                    if near is not None:
                        near.unpersist()
                    base, radius = now, REACH * step
                    near = _sums_and_near(placed, d, now, radius).persist()
                    settled = _totals(near, d, k)
                    if n_rows - sum(n for n, _ in settled) <= NEAR_ROWS:
                        now, left, step = _settle(near, d, now, radius, settled, left)
                        continue
                after = _moved(now, settled, _totals(_sums_and_near(near.where("cluster IS NULL"), d, now, None), d, k))
            step, now, left = _step(now, after), after, left - 1
    finally:
        if near is not None:
            near.unpersist()
    ratio = columns.index(params.ratio_column) if params.ratio_column in columns else d - 1
    return tuple(sorted(now, key=lambda c: (c[ratio], c)))


def train(features: DataFrame, params: Params = DEFAULTS, min_rows: int = 1, complete: bool = False) -> Fitted:
    """Complete rows -> points, kept in memory and on disk while the passes read them -> fit.

    ``complete`` says that incomplete rows are gone already, and spares reading all columns to find
    them. Fewer than ``min_rows`` rows raise ValueError.
    """
    columns = params.feature_columns
    rows = features if complete else drop_incomplete(features)
    points = unit_points(rows, columns).persist()
    n, means, deviations = _moments(points, columns)
    if n < max(min_rows, 1):
        points.unpersist()
        raise ValueError(f"{n} complete rows are too few to train on (at least {max(min_rows, 1)})")
    placed = points.select(*[x.alias(f"x{i}") for i, x in enumerate(_grid(columns, means, deviations))])
    centers = tuple(tuple(v / GRID for v in center) for center in fit(placed, columns, params))
    scale = [tuple(v / UNITS for v in side) for side in (means, deviations)]
    return Fitted(Centroids(columns, centers, *scale), points, n)


@contextmanager
def trained(features: DataFrame, params: Params = DEFAULTS, **settings) -> Iterator[Fitted]:
    """A fit whose points are released at the end."""
    fitted = train(features, params, **settings)
    try:
        yield fitted
    finally:
        fitted.release()


def scoring_stage(model: Centroids) -> SQLTransformer:
    """Nearest centre as one SQL stage, for users of Spark ML pipelines."""

    def number(v: float) -> str:
        return f"CAST('{v!r}' AS DOUBLE)"

    def square(j: int) -> str:
        terms = []
        for c, m, s, v in zip(model.columns, model.means, model.deviations, model.centers[j]):
            x = f"({c} - {number(m)}) / {number(s)}" if s > 0 else number(0.0)
            terms.append(f"power({x} - {number(v)}, 2)")
        return "(" + " + ".join(terms) + ")"

    nearest = ", ".join(f"named_struct('d', {square(j)}, 'j', {j})" for j in range(model.k))
    chosen = f"least({nearest})" if model.k > 1 else nearest
    return SQLTransformer(statement=f"SELECT *, {chosen}.j AS {CLUSTER} FROM __THIS__")


def evaluate(fitted: Fitted) -> DataFrame:
    """One row: squared-Euclidean silhouette, inertia, clusters, rows."""
    assigned = assign(fitted.points, fitted.centroids, keep=True)
    return silhouette_squared(assigned, fitted.centroids).select(
        "silhouette_sq",
        inertia(assigned).select("inertia").scalar().alias("inertia"),
        F.lit(fitted.centroids.k).alias("n_clusters"),
        "n_samples",
    )


def metrics_row(fitted: Fitted, params: Params = DEFAULTS) -> DataFrame:
    """The evaluation with the parameters of the run, for an appended metrics table."""
    return evaluate(fitted).select(
        F.lit("k-means").alias("algorithm"),
        F.lit(params.seed).alias("seed"),
        F.lit(",".join(params.feature_columns)).alias("features"),
        "*",
    )


def centers_frame(fitted: Fitted, spark: SparkSession) -> DataFrame:
    """The fitted centres, one row per cluster (k rows)."""
    rows = [(j, *center) for j, center in enumerate(fitted.centroids.centers)]
    names = ", ".join(f"std_{c} double" for c in fitted.centroids.columns)
    return spark.createDataFrame(rows, f"{CLUSTER} int, {names}")


def save(fitted: Fitted, path: str) -> None:
    """Store the centres with the scale they were trained with, and the pipeline for other users."""
    fitted.pipeline.write().overwrite().save(f"{path}/pipeline")
    c = fitted.centroids
    row = [(list(c.columns), [list(x) for x in c.centers], list(c.means), list(c.deviations), fitted.n_samples)]
    stored = fitted.points.sparkSession.createDataFrame(
        row,
        "columns array<string>, centers array<array<double>>, means array<double>, deviations array<double>, n_samples bigint",
    )
    stored.coalesce(1).write.mode("overwrite").parquet(f"{path}/centers")


def load(spark: SparkSession, *paths: str) -> tuple[PipelineModel, Centroids]:
    """The model of the first path that exists (for example production, then staging).

    A path that exists but cannot be read raises: another model must not silently take its place.
    """
    for path in paths:
        try:
            stored = spark.read.parquet(f"{path}/centers")
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        row = stored.first()
        sides = (tuple(map(tuple, row["centers"])), tuple(row["means"]), tuple(row["deviations"]))
        return PipelineModel.load(f"{path}/pipeline"), Centroids(tuple(row["columns"]), *sides)
    raise ValueError("no model at " + ", ".join(paths))


