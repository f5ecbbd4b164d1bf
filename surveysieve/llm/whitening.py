"""Principal components of embeddings, and the embeddings whitened by them.

The components come from subspace iteration with a Chebyshev filter. Only the
product of the covariance with a narrow block of vectors is ever formed, by a
pass over all rows that centres them and adds up X'(XQ) task by task. A
polynomial of the covariance, built from such passes by the three-term
recurrence, is small on the unwanted part of the spectrum and grows fast above
it. QR, the Ritz values and their residuals follow on the driver, whose
matrices are as large as the block; it stops when the residuals certify the
components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from surveysieve.llm.vectors import added_up, matrix, whole_vectors
from surveysieve.sources.sinks import stage_table

COMPONENTS = 4
# Further vectors in the block: the unwanted spectrum begins behind them, so the wanted part stands out more.
GUARD = 20
DEGREE = 8
# Largest angle, in radians, between a component and the true one, as the residuals prove it.
TOLERANCE = 1e-12
MOST_FILTERS = 500

_EPS = float(np.finfo(np.float64).eps)
_LONG = 2**63 - 1

Product = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Moments:
    """Number of vectors and the exact sums of their components."""

    n: int
    sums: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return self.sums / self.n

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exact."""
        return self.n * x - self.sums

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x less the mean, rounded once."""
        return self.deviations(x) / self.n


@dataclass(frozen=True)
class Components:
    """Unit eigenvectors of the covariance in columns, by falling eigenvalue, and its trace.

    ``angles`` bounds how far each one is from the true eigenvector, as far as its
    eigenvalue is apart from the others.
    """

    vectors: np.ndarray
    values: np.ndarray
    trace: float
    angles: np.ndarray


def moments(vectors: DataFrame) -> Moments | None:
    """Of all rows of ``vectors`` (x); None if there are none."""
    first = vectors.select("x").head()
    if first is None:
        return None
    width = len(first["x"])
    total = added_up(
        vectors.select("x"), lambda x: np.concatenate([[len(x)], x.sum(axis=0)]).astype(np.int64), width + 1
    )
    return Moments(int(total[0]), total[1:])


def covariance_product(vectors: DataFrame, about: Moments) -> Product:
    """Q -> VQ for the covariance V of all rows: one distributed pass, centred before multiplying."""

    def product(block: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            centred = about.centred(x)
            return (centred.T @ (centred @ block)).ravel()

        return added_up(vectors.select("x"), part, block.size, np.float64).reshape(block.shape) / about.n

    return product


def total_variance(vectors: DataFrame, about: Moments) -> float:
    """Trace of the covariance."""
    return float(added_up(vectors.select("x"), lambda x: np.array([(about.centred(x) ** 2).sum()]), 1, np.float64)[0]) / about.n


def chebyshev_filter(product: Product, block: np.ndarray, image: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """p(V) block for the Chebyshev polynomial of [low, high], scaled to about 1 at ``top``.

    ``image`` is V block. The three-term recurrence takes ``degree`` - 1 products.
    """
    half, middle = (high - low) / 2, (high + low) / 2
    scale = half / (middle - top)
    first = scale
    before, now = block, (image - middle * block) * (scale / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - scale)
        before, now = now, (product(now) - middle * now) * (2 * following / half) - (scale * following) * before
        scale = following
    return now


def leading_components(
    product: Product,
    width: int,
    wanted: int,
    guard: int = GUARD,
    degree: int = DEGREE,
    tolerance: float = TOLERANCE,
    most_filters: int = MOST_FILTERS,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit eigenvectors in columns, eigenvalues falling, bounds of their angles) of a covariance of ``width``.

    Goes on until each wanted residual is at most ``tolerance`` times the distance of
    its Ritz value to the others, or is no larger than rounding makes it: an
    eigenvalue that occurs twice has no single eigenvector, and any will do.
    """
    size = min(width, wanted + guard)
    wanted = min(wanted, size)
    block = np.linalg.qr(np.random.default_rng(20_240).standard_normal((width, size)))[0]
    for _ in range(most_filters):
        image = product(block)
        ritz, turn = np.linalg.eigh((block.T @ image + image.T @ block) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        block, image = block @ turn, image @ turn
        residuals = np.linalg.norm(image - block * ritz, axis=0)[:wanted]
        apart = np.abs(np.subtract.outer(ritz[:wanted], ritz))
        apart[np.arange(wanted), np.arange(wanted)] = np.inf
        gaps = apart.min(axis=1, initial=np.inf)
        rounding = 4 * _EPS * width * max(ritz[0], 0.0)
        angles = np.divide(residuals, gaps, out=np.full(wanted, np.inf), where=gaps > 0)
        # A block of full width spans everything: one step is exact.
        if size == width or ((residuals <= tolerance * gaps) | (residuals <= rounding)).all():
            return block[:, :wanted], ritz[:wanted], angles
        # The unwanted spectrum lies between 0 and the least Ritz value of the block.
        high = min(max(ritz[-1], _EPS * ritz[0]), ritz[0] * (1 - 1e-9))
        block = np.linalg.qr(chebyshev_filter(product, block, image, 0.0, high, ritz[0], degree))[0]
    raise RuntimeError(f"components are not certified after {most_filters} filters; residuals {residuals}")


def fit(vectors: DataFrame, wanted: int = COMPONENTS) -> tuple[Moments, Components] | None:
    """Moments and leading components of all rows of ``vectors`` (x); None if nothing varies.

    Components whose eigenvalue is 0 up to rounding are left out: nothing can be whitened along them.
    """
    about = moments(vectors)
    if about is None:
        return None
    trace = total_variance(vectors, about)
    if trace == 0:
        return None
    product = covariance_product(vectors, about)
    directions, values, angles = leading_components(product, len(about.sums), wanted)
    real = values > 64 * _EPS * len(about.sums) * values[0]
    return about, Components(directions[:, real], values[real], trace, angles[real])


def identity_error(vectors: DataFrame, about: Moments, components: Components) -> float:
    """Largest entry, in size, of the covariance of the whitened rows less the identity."""
    scaled = components.vectors / np.sqrt(components.values)
    width = scaled.shape[1]

    def part(x: np.ndarray) -> np.ndarray:
        white = about.centred(x) @ scaled
        return np.concatenate([white.sum(axis=0), (white.T @ white).ravel()])

    total = added_up(vectors.select("x"), part, width * (width + 1), np.float64) / about.n
    mean, products = total[:width], total[width:].reshape(width, width)
    return float(np.abs(products - np.outer(mean, mean) - np.eye(width)).max())


def project(rows: DataFrame, about: Moments, components: Components) -> DataFrame:
    """(vec_id, component, deviation, whitened) of each row of ``rows`` (vec_id, x) and component.

    ``deviation`` is the squared length of n * x - sums, exact; null if it is beyond a long.
    """
    scaled = components.vectors / np.sqrt(components.values)
    width = scaled.shape[1]

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("x"))
            white = about.centred(x) @ scaled
            repeated = np.repeat(np.arange(len(x)), width)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(repeated)),
                    pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(x))),
                    _squared_lengths(about.deviations(x)).take(pa.array(repeated)),
                    pa.array(white.ravel()),
                ],
                ["vec_id", "component", "deviation", "whitened"],
            )

    return rows.select("vec_id", "x").mapInArrow(task, _projected(rows))


def _projected(rows: DataFrame) -> T.StructType:
    schema = T.StructType([rows.schema["vec_id"]])
    return schema.add("component", T.IntegerType()).add("deviation", T.LongType()).add("whitened", T.DoubleType())


def _squared_lengths(deviations: np.ndarray) -> pa.Array:
    largest = int(np.abs(deviations).max(initial=0))
    if largest**2 * deviations.shape[1] <= _LONG:
        return pa.array((deviations**2).sum(axis=1))
    exact = (deviations.astype(object) ** 2).sum(axis=1)
    return pa.array([value if value <= _LONG else None for value in exact], pa.int64())


def whiten(embeddings: DataFrame, wanted: int = COMPONENTS, vector: str = "embedding") -> tuple[DataFrame, Moments | None, Components | None, float]:
    """(rows of ``project``, moments, components, identity error) of every usable row of ``embeddings``.

    Moments and components are those of the distinct vectors. Rows whose vector is
    null or empty, or holds a null, a NaN or an infinity are dropped; repeated rows
    and ids are rows of their own. Without rows, or if all vectors are equal, there are no
    components and so no rows; with fewer real components than wanted, rows have
    only these. Vectors that differ in length and components of 2**19 or more are
    errors. Other columns are ignored.
    """
    rows = stage_table(whole_vectors(embeddings, "vec_id", vector=vector), "vectors")
    distinct = stage_table(rows.select("x").distinct(), "distinct-vectors")
    fitted = fit(distinct, wanted)
    if fitted is None:
        return rows.sparkSession.createDataFrame([], _projected(rows)), None, None, 0.0
    about, components = fitted
    return project(rows, about, components), about, components, identity_error(distinct, about, components)
