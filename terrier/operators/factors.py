"""A regression whose coefficients vary by city and department through learned factors.

Prices are read as x * (w + P u[city] + Q v[department]), with x the standardised numeric columns and a one.
Everything that fitting needs of the rows are their sums of x x', x y and y y by city and department: one
pass gathers them into a table, and the alternating steps run over that table. A city's factor
follows from its own sums and the shared matrices, so a pass solves it where the sums are; it is
written down once, at the end. Only the shared matrices and the departments' factors are on the driver.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrier.sources.scratch import own_shuffles_removed, settle

# What runs in tasks is shipped with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SUMS = "city long, part int, dep long, n double, yy double, t array<double>, s array<double>"
_NAMES = ["city", "part", "dep", "n", "yy", "t", "s"]


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _lists(matrix: np.ndarray) -> pa.ListArray:
    rows, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * width), pa.array(matrix.ravel()))


def _batch(keys: np.ndarray, sums: np.ndarray, size: int) -> pa.RecordBatch:
    arrays = [pa.array(keys[:, 0]), pa.array(keys[:, 1].astype(np.int32)), pa.array(keys[:, 2])]
    arrays += [pa.array(sums[:, 0]), pa.array(sums[:, 1]), _lists(sums[:, 2 : 2 + size]), _lists(sums[:, 2 + size :])]
    return pa.RecordBatch.from_arrays(arrays, names=_NAMES)


def _grouped(keys: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows with equal keys, in key order."""
    order = np.lexsort(keys.T[::-1])
    keys, sums = keys[order], sums[order]
    starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
    return keys[starts], np.add.reduceat(sums, starts, axis=0)


def _summed_rows(rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """n, yy, t and S of each stretch of rows (y, x...)."""
    x = np.concatenate([np.ones((len(rows), 1)), rows[:, 1:]], axis=1)
    outer = (x[:, :, None] * x[:, None, :]).reshape(len(x), -1)
    y = rows[:, :1]
    return np.add.reduceat(np.concatenate([np.ones_like(y), y * y, x * y, outer], axis=1), starts, axis=0)


def _dealt(rows: DataFrame, size: int) -> DataFrame:
    """Rows (city, part, dep, y, x...) dealt and sorted by city: few of a key as they are, more of them as their sums.

    The rows of a key in a batch are one record: ``k`` rows of (y, x...) behind one another, or, where they would take
    more room than their sums, n, yy, t and the upper half of S with a ``k`` of 0. So a city with a third of all
    rows is a record for each batch, and no record is larger than its rows.
    """
    upper = np.triu_indices(size)
    half = 2 + size + len(upper[0])

    def partial(batches):
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)], axis=1)
            values = np.stack([b.column(3 + i).to_numpy(zero_copy_only=False) for i in range(size)], axis=1)
            order = np.lexsort(keys.T[::-1])
            keys, values = keys[order], values[order]
            starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
            counts = np.diff(np.append(starts, len(keys)))
            few = counts * size <= half
            if few.any():
                yield record(keys[starts[few]], counts[few], counts[few] * size, values[np.repeat(few, counts)])
            if not few.all():
                found = []
                for start, n in zip(starts[~few].tolist(), counts[~few].tolist(), strict=True):
                    whole = sum(_summed_rows(values[a : min(a + 5000, start + n)], np.zeros(1, np.int64)) for a in range(start, start + n, 5000))
                    found.append(np.concatenate([whole[0, : 2 + size], whole[0, 2 + size :].reshape(size, size)[upper]]))
                many = np.zeros(len(found), np.int64)
                yield record(keys[starts[~few]], many, many + half, np.stack(found))

    def record(keys, rows, lengths, values):
        ends = np.append(0, np.cumsum(lengths)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))
        arrays = [pa.array(keys[:, 0]), pa.array(keys[:, 1].astype(np.int32)), pa.array(keys[:, 2]), pa.array(rows.astype(np.int32)), lists]
        return pa.RecordBatch.from_arrays(arrays, names=["city", "part", "dep", "k", "v"])

    records = rows.mapInArrow(partial, "city long, part int, dep long, k int, v array<double>")
    return records.repartition("city").sortWithinPartitions("city", "part", "dep")


def _merged(batches, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys and sums of what was dealt; a table ends where a city ends."""
    half = 2 + size + size * (size + 1) // 2

    def tables():
        for whole in batches:
            for a in range(0, whole.num_rows, 512):
                b = whole.slice(a, 512)
                keys = np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)], axis=1)
                rows = b.column(3).to_numpy(zero_copy_only=False).astype(np.int64)
                values, lengths = b.column(4).flatten().to_numpy(zero_copy_only=False), np.where(rows, rows * size, half)
                plain = np.repeat(rows > 0, lengths)
                sums = np.empty((len(keys), 2 + size + size * size))
                if plain.any():
                    own = rows[rows > 0]
                    sums[rows > 0] = _summed_rows(values[plain].reshape(-1, size), np.cumsum(own) - own)
                if not plain.all():
                    sums[rows == 0] = _whole(values[~plain].reshape(-1, half), size)
                yield keys, sums

    held = None
    for keys, sums in tables():
        if held is not None:
            keys, sums = np.concatenate([held[0], keys]), np.concatenate([held[1], sums])
        keys, sums = _grouped(keys, sums)
        last = keys[:, 0] == keys[-1, 0]  # a city may go on in the next batch
        if not last.all():
            yield keys[~last], sums[~last]
        held = keys[last], sums[last]
    if held is not None:
        yield held


def _whole(halves: np.ndarray, size: int) -> np.ndarray:
    """Sums with all of S, from sums with its upper half."""
    rows, columns = np.triu_indices(size)
    s = np.empty((len(halves), size, size))
    s[:, rows, columns] = s[:, columns, rows] = halves[:, 2 + size :]
    return np.concatenate([halves[:, : 2 + size], s.reshape(len(halves), -1)], axis=1)


def statistics(rows: DataFrame, size: int) -> DataFrame:
    """Sums by city, part and department of rows (city, part, dep, y, x...), dealt and sorted by city."""

    def merge(batches):
        for keys, sums in _merged(batches, size):
            yield _batch(keys, sums, size)

    return _dealt(rows, size).mapInArrow(merge, _SUMS)


def city_records(rows: DataFrame, size: int) -> DataFrame:
    """The same sums with one record a city: its parts and departments, and for each n, yy, t and the upper half of S.

    However the files of these are cut, a city stays whole, so passes over them need no shuffle.
    """
    upper = np.flatnonzero(np.triu(np.ones((size, size))).ravel()) + 2 + size

    def merge(batches):
        for keys, sums in _merged(batches, size):
            starts = np.flatnonzero(np.append(True, keys[1:, 0] != keys[:-1, 0]))
            ends = np.append(starts, len(keys)).astype(np.int32)
            halves = np.concatenate([sums[:, : 2 + size], sums[:, upper]], axis=1)
            lists = [pa.array(keys[:, 1].astype(np.int32)), pa.array(keys[:, 2]), pa.array(halves.ravel())]
            widths = 1, 1, halves.shape[1]
            arrays = [pa.ListArray.from_arrays(pa.array(ends * w), x) for w, x in zip(widths, lists, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(keys[starts, 0]), *arrays], names=["city", "part", "dep", "v"])

    return _dealt(rows, size).mapInArrow(merge, "city long, part array<int>, dep array<long>, v array<double>")


@dataclass
class Shared:
    """w, P and Q as one matrix (a row for each column of x), and the departments' factors."""

    matrix: np.ndarray
    cities: int
    departments: dict[int, np.ndarray]
    ridge: float

    def parts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.matrix[:, 0], self.matrix[:, 1 : 1 + self.cities], self.matrix[:, 1 + self.cities :]


def _cities(batches, shared: Shared) -> Iterator[tuple]:
    """For the rows of each batch: keys, sums n, yy, t, S, the city's factor and the department's."""
    w, p, q = shared.parts()
    size = len(w)
    none = np.zeros(q.shape[1])
    for keys, sums in _whole_cities(batches, size):
        t, s = sums[:, 2 : 2 + size], sums[:, 2 + size :].reshape(-1, size, size)
        v = np.stack([shared.departments.get(d, none) for d in keys[:, 2].tolist()])
        left = t - np.einsum("nij,nj->ni", s, w + v @ q.T)
        fit = keys[:, 1] == 0
        starts = np.flatnonzero(np.append(True, keys[1:, 0] != keys[:-1, 0]))
        gram = np.add.reduceat(np.where(fit[:, None, None], s, 0.0), starts, axis=0)
        right = np.add.reduceat(np.where(fit[:, None], left, 0.0), starts, axis=0)
        gram = np.einsum("ik,nij,jl->nkl", p, gram, p, optimize=True) + shared.ridge * np.eye(p.shape[1])
        found = np.linalg.solve(gram, (right @ p)[:, :, None])[:, :, 0]
        u = np.repeat(found, np.diff(np.append(starts, len(keys))), axis=0)
        yield keys, sums[:, 0], sums[:, 1], t, s, u, v


def _whole_cities(batches, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tables of some thousand keys that end where a city ends; a city has a row for each department and part, no more."""
    half = 2 + size + size * (size + 1) // 2
    for whole in batches:
        if not whole.num_rows:
            continue
        counts = np.diff(whole.column(1).offsets.to_numpy())
        pieces = np.cumsum(counts) // 4096
        starts = np.flatnonzero(np.append(True, pieces[1:] != pieces[:-1]))
        for a, z in zip(starts.tolist(), [*starts[1:].tolist(), len(pieces)], strict=True):
            b = whole.slice(a, z - a)
            city = np.repeat(b.column(0).to_numpy(zero_copy_only=False), counts[a:z])
            part, dep, values = (b.column(i).flatten().to_numpy(zero_copy_only=False) for i in (1, 2, 3))
            yield np.stack([city, part.astype(np.int64), dep], axis=1), _whole(values.reshape(-1, half), size)


def _summed(stats: DataFrame, rows, width: int) -> dict[int, np.ndarray]:
    """The sums of the vectors that tasks give by key. Keys and widths don't depend on the cities."""

    def partial(batches):
        held: dict[int, np.ndarray] = {}
        for keys, values in rows(batches):
            for k, value in zip(keys, values, strict=True):
                held[k] = held.get(k, 0.0) + value
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.int64()), _lists(np.stack(list(held.values())))], names=["k", "v"]
            )

    def merge(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for k, value in zip(b.column(0).to_pylist(), _matrix(b.column(1), width), strict=True):
                held[k] = held.get(k, 0.0) + value
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.int64()), _lists(np.stack(list(held.values())))], names=["k", "v"]
            )

    kind = "k long, v array<double>"
    with own_shuffles_removed(stats.sparkSession):
        found = stats.mapInArrow(partial, kind).repartition("k").mapInArrow(merge, kind).collect()
    return {r["k"]: np.array(r["v"]) for r in found}


def _department_step(stats: DataFrame, shared: Shared) -> tuple[dict[int, np.ndarray], float, float]:
    """New factors of the departments, and the errors on fitted and validation rows before them."""
    w, p, q = shared.parts()
    size, k = len(w), q.shape[1]
    width = max(k * k + k, 2)

    def rows(batches):
        for keys, n, yy, t, s, u, v in _cities(batches, shared):
            fit = keys[:, 1] == 0
            m = w + u @ p.T + v @ q.T
            error = yy - 2 * (m * t).sum(axis=1) + np.einsum("ni,nij,nj->n", m, s, m, optimize=True)
            found = []
            for part in (fit, ~fit):
                row = np.zeros(width)
                row[:2] = error[part].sum(), n[part].sum()
                found.append(row)
            yield [-1, -2], found
            left = (t - np.einsum("nij,nj->ni", s, w + u @ p.T)) @ q
            gram = np.einsum("ik,nij,jl->nkl", q, s, q, optimize=True).reshape(len(n), -1)
            values = np.concatenate([gram, left, np.zeros((len(n), width - k * k - k))], axis=1)[fit]
            deps = keys[fit, 2]
            order = np.argsort(deps, kind="stable")
            if len(order):
                starts = np.flatnonzero(np.append(True, deps[order][1:] != deps[order][:-1]))
                yield deps[order][starts].tolist(), np.add.reduceat(values[order], starts, axis=0)

    sums = _summed(stats, rows, width)
    fitted, held = sums.pop(-1, np.zeros(2)), sums.pop(-2, np.zeros(2))
    step = {
        d: np.linalg.solve(x[: k * k].reshape(k, k) + shared.ridge * np.eye(k), x[k * k : k * k + k]) for d, x in sums.items()
    }
    return step, fitted[0] / max(fitted[1], 1.0), held[0] / held[1] if held[1] else float("nan")


def _shared_step(stats: DataFrame, shared: Shared) -> np.ndarray:
    """The shared matrix that fits best with the factors as they are."""
    size, wide = shared.matrix.shape

    def rows(batches):
        for keys, _, _, t, s, u, v in _cities(batches, shared):
            fit = keys[:, 1] == 0
            a = np.concatenate([np.ones((len(u), 1)), u, v], axis=1)[fit]
            gram = s[fit].reshape(len(a), -1).T @ (a[:, :, None] * a[:, None, :]).reshape(len(a), -1)
            right = t[fit].T @ a
            values = np.zeros((size * size + size, wide * wide))
            values[: size * size], values[size * size :, :wide] = gram, right
            yield range(len(values)), values

    sums = _summed(stats, rows, wide * wide)
    gram = np.stack([sums[i] for i in range(size * size)]).reshape(size, size, wide, wide).transpose(0, 2, 1, 3)
    right = np.stack([sums[size * size + i][:wide] for i in range(size)]).ravel()
    gram = gram.reshape(size * wide, size * wide) + 1e-6 * max(1.0, shared.ridge) * np.eye(size * wide)
    return np.linalg.solve(gram, right).reshape(size, wide)


@dataclass
class FactorModel:
    """``transform`` adds ``prediction``; ``cities`` is a table (city, factor, effect) that Spark joins."""

    features: list[str]
    columns: tuple[str, str]
    centre: list[float]
    scale: list[float]
    base: float
    shared: list[float]
    departments: dict[int, list[float]]
    losses: list[float]
    cities: DataFrame
    prediction: str = "log_price"

    def transform(self, df: DataFrame) -> DataFrame:
        """An unknown city or department has no effect of its own."""
        dep, city = self.columns
        spark = df.sparkSession
        one = [F.lit(1.0)] + [
            (F.col(f"`{c}`").cast("double") - m) / s for c, m, s in zip(self.features, self.centre, self.scale, strict=True)
        ]
        none = F.array_repeat(F.lit(0.0), len(one))
        effects = spark.createDataFrame(list(self.departments.items()), "_dep long, _dep_effect array<double>")
        joined = df.join(self.cities.select(F.col("city").alias("_city"), F.col("effect").alias("_effect")), F.col(f"`{city}`").cast("long") == F.col("_city"), "left")
        joined = joined.join(F.broadcast(effects), F.col(f"`{dep}`").cast("long") == F.col("_dep"), "left")
        own, more = F.coalesce("_effect", none), F.coalesce("_dep_effect", none)
        total = F.lit(self.base)
        for i, x in enumerate(one):
            total = total + x * (F.lit(self.shared[i]) + own[i] + more[i])
        return joined.withColumn(self.prediction, total).drop("_city", "_effect", "_dep", "_dep_effect")

    def save(self, spark: SparkSession, path: str) -> None:
        self.cities.write.mode("overwrite").parquet(f"{path}/cities")
        head = {k: v for k, v in self.__dict__.items() if k != "cities"}
        spark.createDataFrame([(json.dumps(head),)], "head string").coalesce(1).write.mode("overwrite").parquet(f"{path}/factors")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FactorModel:
        head = json.loads(spark.read.parquet(f"{path}/factors").first()["head"])
        head["departments"] = {int(k): v for k, v in head["departments"].items()}
        head["columns"] = tuple(head["columns"])
        return cls(cities=spark.read.parquet(f"{path}/cities"), **head)


def fit_factors(
    fit: DataFrame,
    target: str,
    numeric: list[str],
    department: str,
    city: str,
    validation: DataFrame | None = None,
    patience: int = 5,
    department_size: int = 8,
    city_size: int = 32,
    rounds: int = 100,
    ridge: float = 1.0,
    tolerance: float = 1e-3,
    seed: int = 42,
    prediction: str = "log_price",
) -> FactorModel:
    """Alternating ridge regressions: cities, departments, shared matrices.

    Fitting ends after ``patience`` rounds in which the error on validation rows didn't fall by ``tolerance`` of
    itself, and the state of the lowest is kept; without them, when the error on the fitted rows falls by
    less than that in a round. Columns must be complete. Cities and departments are whole-number codes.
    """
    moments = fit.agg(F.avg(target), *[f(F.col(f"`{c}`").cast("double")) for c in numeric for f in (F.avg, F.stddev_pop)]).first()
    if moments[0] is None:
        raise ValueError("no rows to fit")
    base, centre = float(moments[0]), [float(m) for m in moments[1::2]]
    scale = [float(s) or 1.0 for s in moments[2::2]]

    def rows(df: DataFrame, part: int) -> DataFrame:
        x = [((F.col(f"`{c}`").cast("double") - m) / s).alias(f"x{i}") for i, (c, m, s) in enumerate(zip(numeric, centre, scale, strict=True))]
        keys = [F.col(f"`{city}`").cast("long").alias("city"), F.lit(part).alias("part"), F.col(f"`{department}`").cast("long").alias("dep")]
        return df.select(*keys, (F.col(target).cast("double") - base).alias("y"), *x)

    both = rows(fit, 0) if validation is None else rows(fit, 0).union(rows(validation, 1))
    size = len(numeric) + 1
    stats = settle(city_records(both, size), "city_sums")
    draw = np.random.default_rng(seed)
    matrix = np.concatenate([np.zeros((size, 1)), draw.normal(0, 1 / np.sqrt(size), (size, city_size + department_size))], axis=1)
    shared = Shared(matrix, city_size, {}, ridge)
    losses: list[float] = []
    best, mark, kept, before = 0, 0, None, np.inf
    for number in range(rounds + 1):
        step, fitted, held = _department_step(stats, shared)
        loss = held if validation is not None else fitted
        losses.append(float(loss))
        if kept is None or loss < losses[best]:
            # Alternating steps gain a little for a long time: patience starts anew for a gain that counts.
            if loss < losses[mark] * (1 - tolerance):
                mark = number
            best, kept = number, Shared(shared.matrix, city_size, shared.departments, ridge)
        stalled = number - mark >= patience if validation is not None else before - fitted < tolerance * fitted
        if number == rounds or (stalled and number > 1):
            break
        before = fitted
        shared = Shared(shared.matrix, city_size, step, ridge)
        shared = Shared(_shared_step(stats, shared), city_size, step, ridge)
    w, p, q = kept.parts()

    def factors(batches):
        for keys, *_, u, _ in _cities(batches, kept):
            at = np.flatnonzero(np.append(True, keys[1:, 0] != keys[:-1, 0]))
            arrays = [pa.array(keys[at, 0]), _lists(u[at]), _lists(u[at] @ p.T)]
            yield pa.RecordBatch.from_arrays(arrays, names=["city", "factor", "effect"])

    cities = settle(stats.mapInArrow(factors, "city long, factor array<double>, effect array<double>"), "city_factors")
    departments = {int(d): (q @ v).tolist() for d, v in kept.departments.items()}
    return FactorModel(
        list(numeric), (department, city), centre, scale, base, w.tolist(), departments, losses[: best + 1], cities, prediction
    )
