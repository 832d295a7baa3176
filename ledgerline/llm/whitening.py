"""Whitening of embeddings on principal axes, found by spectral divide and conquer.

Vectors become integers, floor(1024 * entry) + 100000.  Tasks add up their sums and
then their centred products; the covariance, one matrix of the vectors' width, is
what reaches the driver.  There a shifted covariance's polar factor, by dynamically
weighted Halley steps (QDWH), gives the projector on the eigenvectors above the
shift; the covariance is split along both subspaces, and those that hold wanted
components are split again until each is one component.  The axes are broadcast,
and every row is whitened where it lies.

Defined results: rows whose vector is null, or holds a null, non-finite or huge (2**40
and more after scaling) entry, are left out; a shorter vector counts as ended by
zeros; fewer than `most` axes give fewer rows; where an axis has no variance (to
rounding), whitened is null, and identity_error leaves that axis out; a deviation
that no long holds is null; repeated rows count each; a null id stays null; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import lengths, parts, scaled

SCALE, SHIFT, BITS = 1024.0, 100_000, 40
EPS = float(np.finfo(float).eps)


def polar(a: np.ndarray, most: int = 40) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix that is not singular, by QDWH."""
    d = len(a)
    x = a / np.linalg.norm(a)
    # the inverse's Frobenius norm bounds the smallest singular value from below
    low = min(1.0, max(1 / np.linalg.norm(np.linalg.inv(x)), EPS))
    eye = np.eye(d)
    for _ in range(most):
        low2 = low * low
        spread = np.cbrt(4 * (1 - low2) / (low2 * low2))
        root = np.sqrt(1 + spread)
        p = root + np.sqrt(max(8 - 4 * spread + 8 * (2 - low2) / (low2 * root), 0)) / 2
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        before = x
        if r > 100:  # far from orthogonal: by QR, which no bad condition spoils
            both, _ = np.linalg.qr(np.vstack([np.sqrt(r) * x, eye]))
            x = q / r * x + (p - q / r) / np.sqrt(r) * both[:d] @ both[d:].T
        else:
            x = q / r * x + (p - q / r) * np.linalg.solve(eye + r * x.T @ x, x.T).T
        x = (x + x.T) / 2
        low = min(1.0, low * (p + q * low2) / (1 + r * low2))
        if np.linalg.norm(x - before) <= np.cbrt(5 * EPS) and 1 - low < 10 * EPS:
            break
    return x


def split(a: np.ndarray, tiny: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the eigenvectors above and below a shift; None where all eigenvalues agree to within `tiny`."""
    d = len(a)
    mean = np.trace(a) / d
    if np.linalg.norm(a - mean * np.eye(d)) <= tiny:
        return None
    # the mean of the diagonal parts the spectrum; its median parts it more evenly, if at all
    diagonal = np.diag(a)
    tries = [np.median(diagonal), mean] + [mean + s * k * np.ptp(diagonal) / 64 for k in (1, 3, 9) for s in (1, -1)]
    for shift in tries:
        try:
            above = (np.eye(d) + polar(a - shift * np.eye(d))) / 2
        except np.linalg.LinAlgError:  # the shift is an eigenvalue
            continue
        k = int(np.rint(np.trace(above)))
        if 0 < k < d and abs(np.trace(above) - k) < 1e-6:
            first, _ = np.linalg.qr(above @ np.random.default_rng(d).standard_normal((d, k)))
            basis, _ = np.linalg.qr(above @ first, mode="complete")
            return basis[:, :k], basis[:, k:]
    return None


def components(a: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The greatest `most` eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns."""
    todo, values, vectors, tiny = [(np.eye(len(a)), a)], [], [], 4 * EPS * np.linalg.norm(a)
    while todo and len(values) < most:
        basis, block = todo.pop()
        parted = split(block, tiny) if len(block) > 1 else None
        if parted is None:
            values += list(np.diag(block))
            vectors += list(basis.T)
            continue
        for side in reversed(parted):  # the upper side is taken next
            lower = side.T @ block @ side
            todo.append((basis @ side, (lower + lower.T) / 2))
    order = np.argsort(-np.array(values), kind="stable")[:most]
    axes = np.array(vectors).reshape(-1, len(a))[order].T
    return np.einsum("ij,ik,kj->j", axes, a, axes), axes


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total = 0, np.zeros(0, np.int64)
    for batch in batches:
        width = int(lengths(batch.column(0)).max(initial=0))
        for part in parts(batch, width):
            ok, x = scaled(part.column(0), SCALE, width, BITS)
            total = np.pad(total, (0, max(0, width - len(total))))
            total[:width] += x.sum(0)
            n += int(ok.sum())
    # the count goes first, for position 0
    yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([[n], total])], pa.list_(pa.int64()))], ["sums"])


def _products(rows_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for y in rows_of(batch):
                total += y.T @ y
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(np.full(width, task, np.int32)), pa.array(list(total), pa.list_(pa.float64()))], ["i", "task", "products"])

    return run


def _added(table: pa.Table) -> pa.Table:
    """The sum of one line of all tasks' products, in the order of tasks, so that reruns agree."""
    table = table.sort_by("task")
    total = np.sum(np.array(table.column("products").to_pylist(), float), axis=0)
    return pa.table({"i": table.column("i").slice(0, 1), "products": pa.array([total], pa.list_(pa.float64()))})


def second_moments(vectors: DataFrame, rows_of: Callable, width: int) -> np.ndarray:
    """The sum of products y'y over all rows that `rows_of` makes of a batch; a task sends one row for each line."""
    tasks = vectors.mapInArrow(_products(rows_of, width), "i int, task int, products array<double>")
    lines = tasks.groupBy("i").applyInArrow(_added, "i int, products array<double>").collect()
    return np.array([r["products"] for r in sorted(lines, key=lambda r: r["i"])], float).reshape(width, width)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum over dimensions of (n * x - S)**2, exactly."""
    if not x.size:
        return pa.array(np.zeros(len(x), np.int64))
    rough = ((x * float(n) - np.array(sums, float)) ** 2).sum(1)
    small = np.abs(x).max() * float(n) < 2.0**62 and max(map(abs, sums)) < 2**62
    if small and rough.max() < 2.0**62:
        return pa.array(((x * n - np.array(sums, np.int64)) ** 2).sum(1))
    exact = (sum((n * v - s) ** 2 for v, s in zip(map(int, row), sums, strict=True)) for row in x)
    return pa.array([v if v < 2**63 else None for v in exact], pa.int64())


def whiten(vectors: DataFrame, most: int = 8) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: one row for each vector that takes part and each of `most` components."""
    spark = vectors.sparkSession
    only = vectors.select("embedding")
    sums = only.mapInArrow(_sums, "sums array<long>").select(F.posexplode("sums").alias("at", "part")).groupBy("at").agg(F.sum("part").alias("part"))
    found = {r["at"]: r["part"] for r in sums.collect()}
    n, width = found.get(0) or 0, max(len(found) - 1, 0)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not n or not width:
        return spark.createDataFrame([], schema)
    total = [found[k + 1] + n * SHIFT for k in range(width)]
    # the shift cancels; without it the means keep more digits
    means = np.array([float(found[k + 1]) / n for k in range(width)])

    def centred(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for part in parts(batch, width):
            yield scaled(part.column(0), SCALE, width, BITS)[1] - means

    covariance = second_moments(only, centred, width) / n
    covariance = (covariance + covariance.T) / 2
    trace = float(np.trace(covariance))
    values, axes = components(covariance, most)
    alive = values > width * EPS * trace
    with np.errstate(divide="ignore", invalid="ignore"):
        weights = np.where(alive, axes / np.sqrt(values), 0.0)

    def projected(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for y in centred(batch):
            yield y @ weights

    spread = second_moments(only, projected, len(values)) / n
    off = np.abs(spread - np.eye(len(values)))[np.ix_(alive, alive)]
    identity_error = float(off.max()) if off.size else 0.0
    share = [float(v / trace) if trace else 0.0 for v in values]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(values)
        for batch in batches:
            for part in parts(batch, width):
                ok, x = scaled(part.column(0), SCALE, width, BITS)
                again = pa.array(np.repeat(np.arange(len(x)), k))
                ids = part.column(1).filter(pa.array(ok)).take(again)
                white = pa.array(((x - means) @ weights).ravel(), mask=np.tile(~alive, len(x)))
                deviation = _deviations(x + SHIFT, n, total).take(again)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), deviation, white, pa.array(np.tile(share, len(x)))],
                    ["vec_id", "component", "deviation", "whitened", "explained"],
                )

    out = vectors.select("embedding", F.col("vec_id").cast("long").alias("vec_id")).mapInArrow(rows, "vec_id long, component int, deviation long, whitened double, explained double")
    return out.select("vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", "explained", F.lit(identity_error).alias("identity_error"))
