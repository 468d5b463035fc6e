"""Whitening of embeddings by principal components of their exact covariance.

Entries become small integers. In blocks of rows every bit plane of every dimension is packed across the
rows into 64-bit words; the number of common bits of two planes, weighted by their places, is a part of the
exact cross-product of two dimensions. Sums of integers are the same in any order, so the scatter matrix
does not depend on how the rows are spread. It is centred as integers before its eigenvectors are taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.session import written

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
#: Rows of which the bit planes are packed at once.
BLOCK_ROWS = 4_096
#: Weighted counts are summed in limbs of so many bits, so that no sum of longs runs over.
LIMB_BITS = 24
#: An eigenvalue of so small a part of the largest one is 0 within double precision.
NO_VARIANCE = 1e-12


def valid_rows(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector) of the rows whose vector has entries, all finite, and of a size that a long can hold."""
    bound = float(2**61 // SCALE)
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")).where(
        (F.size("vector") > 0) & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < bound))
    )


def integers(vectors: pa.Array) -> np.ndarray:
    """x of every entry, a row for each vector."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return np.floor(flat * SCALE).astype(np.int64).reshape(len(vectors), -1) + SHIFT


def ranges(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest x of each dimension; a row per task and dimension is all that is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            if len(batch):
                x = integers(batch.column(0))
                least, most = x.min(0), x.max(0)
                low = least if low is None else np.minimum(low, least)
                high = most if high is None else np.maximum(high, most)
        if low is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(low))), pa.array(low), pa.array(high)], names=["d", "low", "high"])

    found = rows.select("vector").mapInArrow(run, "d long, low long, high long")
    bounds = found.groupBy("d").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("d").toPandas()
    return bounds["low"].to_numpy(np.int64), bounds["high"].to_numpy(np.int64)


def entry_type(span: int) -> np.dtype:
    """The smallest unsigned type for values up to ``span``."""
    return np.dtype(next(f"<u{n}" for n in (1, 2, 4, 8) if span < 1 << (8 * n)))


def fit_list(rows: DataFrame, low: np.ndarray, kind: np.dtype) -> DataFrame:
    """(packed): each different x vector once, less the least values, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                y = (integers(batch.column(0)) - low).astype(kind)
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in y], pa.binary())], names=["packed"])

    return rows.select("vector").mapInArrow(run, "packed binary").distinct()


def unpacked(column: pa.Array, kind: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def bit_planes(y: np.ndarray, bits: int) -> list[np.ndarray]:
    """For each bit the words (dimension, word) of its planes: bit r of a plane belongs to row r."""
    out = []
    for bit in range(bits):
        plane = np.packbits(((y >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8).T, axis=1)
        out.append(np.ascontiguousarray(np.pad(plane, ((0, 0), (0, -plane.shape[1] % 8)))).view(np.uint64))
    return out


def add_scatter(limbs: np.ndarray, y: np.ndarray, bits: int) -> None:
    """Add the block's weighted common bits of every two dimensions, and of each with itself, to the limbs."""
    planes = bit_planes(y.astype(np.uint64), bits)
    for a in range(bits):
        for b in range(a, bits):
            common = np.empty(limbs.shape[1:], np.int64)
            for d, plane in enumerate(planes[a]):
                common[d] = np.bitwise_count(planes[b] & plane).sum(1, dtype=np.int64)
            limb, place = divmod(a + b, LIMB_BITS)
            limbs[limb] += (common if a == b else common + common.T) << place


def scatter(fit: DataFrame, dims: int, bits: int, kind: np.dtype) -> tuple[int, list[int], list[list[int]]]:
    """n, the sums and the cross-products of the fit list's vectors, exactly; a row per task, limb and pair is shuffled."""
    count = (2 * bits - 2) // LIMB_BITS + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limbs, sums, n = np.zeros((count, dims, dims), np.int64), np.zeros((2, dims), np.int64), 0
        for batch in batches:
            for at in range(0, len(batch), BLOCK_ROWS):
                y = unpacked(batch.column(0).slice(at, BLOCK_ROWS), kind)
                add_scatter(limbs, y, bits)
                wide = y.astype(np.uint64)
                sums += np.stack([(wide & np.uint64(0xFFFFFFFF)).sum(0), (wide >> np.uint64(32)).sum(0)]).astype(np.int64)
                n += len(y)
        limb, d, e = np.nonzero(np.triu(np.ones((dims, dims), bool)) & (limbs != 0))
        rows = [(limb, d, e, limbs[limb, d, e])]
        # Sums of single dimensions in two halves as limbs -1 and -2, the number of rows as limb -3.
        for half in (0, 1):
            rows.append((np.full(dims, -1 - half), np.arange(dims), np.arange(dims), sums[half]))
        rows.append(([-3], [0], [0], [n]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in zip(*rows)], names=["limb", "d", "e", "part"])

    parts = fit.mapInArrow(run, "limb long, d long, e long, part long")
    total = parts.groupBy("limb", "d", "e").agg(F.sum(F.col("part").cast("decimal(20,0)")).alias("total"))
    n, sums, cross = 0, [0] * dims, [[0] * dims for _ in range(dims)]
    # At most dims * dims * limbs rows, whatever the table.
    for limb, d, e, part in total.toLocalIterator():
        if limb == -3:
            n = int(part)
        elif limb < 0:
            sums[d] += int(part) << (32 * (-1 - limb))
        else:
            cross[d][e] += int(part) << (LIMB_BITS * limb)
            if d != e:
                cross[e][d] += int(part) << (LIMB_BITS * limb)
    return n, sums, cross


def components_of(n: int, sums: list[int], cross: list[list[int]], most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues, falling, unit eigenvectors as columns, and the trace, of the covariance."""
    centred = [[n * c - s * t for c, t in zip(row, sums)] for row, s in zip(cross, sums)]
    covariance = np.array([[c / (n * n) for c in row] for row in centred])
    values, vectors = np.linalg.eigh(covariance)
    keep = [i for i in np.argsort(-values, kind="stable")[:most] if values[i] > NO_VARIANCE * values[-1] and values[i] > 0]
    return values[keep], vectors[:, keep], float(np.trace(covariance))


def identity_error(fit: DataFrame, project, kind: np.dtype) -> float:
    """The largest absolute entry of the fit list's covariance, after projection, minus the identity.

    Products are centred on the means of a block; what the blocks' means differ by is added from sums.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                w = project(unpacked(batch.column(0), kind))
                mean = w.mean(0)
                own = (w - mean).T @ (w - mean)
                i, j = (x.ravel() for x in np.indices(own.shape))
                columns = [i, j, np.full(len(i), len(w)), own.ravel(), len(w) * mean[i], len(w) * mean[j], len(w) * mean[i] * mean[j]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["i", "j", "n", "own", "a", "b", "ab"])

    parts = fit.mapInArrow(run, "i long, j long, n long, own double, a double, b double, ab double")
    entry = F.expr("(sum(own) + sum(ab) - sum(a) * sum(b) / sum(n)) / sum(n)")
    found = parts.groupBy("i", "j").agg(entry.alias("entry"))
    return found.agg(F.max(F.abs(F.col("entry") - F.expr("CASE WHEN i = j THEN 1D ELSE 0D END")))).first()[0]


def whiten(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """Every row's whitened entries: (vec_id, component, n, deviation, whitened, explained, identity_error).

    Entries c become x = floor(64 c) + 1000000; the covariance is over each different x vector once. Rows
    whose vector is null or empty or holds a null or not finite entry, or one of 2**55 or more, take no
    part; all others do, with null and repeated ids too. Vectors of different lengths raise an
    error. Components without variance (all, if there is one different vector) are left out, as their
    entries are not defined. ``deviation`` is null where it exceeds a long. An empty table gives no rows.
    """
    spark = rows.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    vectors = valid_rows(rows, id_col, vector_col)
    sizes = vectors.agg(F.min(F.size("vector")), F.max(F.size("vector"))).first()
    if sizes[0] is None:
        return spark.createDataFrame([], schema)
    if sizes[0] != sizes[1]:
        raise ValueError(f"vectors of {sizes[0]} to {sizes[1]} entries")
    low, high = ranges(vectors)
    span = int((high - low).max())
    kind, dims = entry_type(span), len(low)
    fit = written(fit_list(vectors, low, kind), "whitening-fit")
    n, sums, cross = scatter(fit, dims, max(1, span.bit_length()), kind)
    values, directions, trace = components_of(n, sums, cross, components)
    if not len(values):
        return spark.createDataFrame([], schema)
    mean, scaled = np.array([s / n for s in sums]), directions / np.sqrt(values)
    explained = values / trace

    def project(y: np.ndarray) -> np.ndarray:
        return (y - mean) @ scaled

    error = identity_error(fit, project, kind)
    # The same numbers modulo 2**64: right whenever the deviation is a long.
    total = np.array([s % 2**64 for s in sums], np.uint64)
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(values)
        for batch in batches:
            if not len(batch):
                continue
            y = integers(batch.column(1)) - low
            apart = np.uint64(n) * y.astype(np.uint64) - total
            exact = (apart * apart).sum(1).view(np.int64)
            near = ((n * (y - mean)) ** 2).sum(1)
            fits = near < 2.0**63 * (1 - 1e-9)
            deviation = pa.array(exact, mask=~fits)
            every = pa.array(np.repeat(np.arange(len(y)), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(every),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(y))),
                    pa.array(np.full(len(y) * k, n)),
                    deviation.take(every),
                    pa.array(project(y).ravel()),
                    pa.array(np.tile(explained, len(y))),
                    pa.array(np.full(len(y) * k, error)),
                ],
                names=names,
            )

    return vectors.mapInArrow(run, schema)
