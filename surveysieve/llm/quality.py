"""Text quality by gradient-boosted trees over histograms of document statistics."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveysieve.llm.common import pick, sampled, slices, texts_of
from surveysieve.sources.sinks import stage_table

# Statistics of a text

SYMBOLS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_GROUPS = {
    "lower": bytes(range(ord("a"), ord("z") + 1)),
    "upper": bytes(range(ord("A"), ord("Z") + 1)),
    "digit": b"0123456789",
    "space": b" ",
    "line": b"\n",
    "stop": b".,;:",
    "bracket": b"()[]{}<>",
    "beyond_ascii": bytes(range(128, 256)),
    "control": bytes([*range(0, 9), *range(11, 32), 127]),
}
NAMES = [
    "log_bytes",
    *(f"share_{name}" for name in _GROUPS),
    *(f"share_{chr(symbol)}" for symbol in SYMBOLS),
    "log_words",
    "word_length",
    "longest_word",
    "distinct_words",
    "top_word",
    "repeated_next",
    "plain_words",
    "capital_words",
    "shouted_words",
    "log_lines",
    "line_length",
    "distinct_lines",
]
_MEMBERS = np.zeros((256, len(_GROUPS)), dtype=np.float64)
for _place, _members in enumerate(_GROUPS.values()):
    _MEMBERS[list(_members), _place] = 1
_SYMBOLS = np.frombuffer(SYMBOLS, dtype=np.uint8)


def statistics(text: str) -> np.ndarray:
    """Figures about a whole text, one for each of ``NAMES``; shares of nothing are 0."""
    data = text.encode()
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    size = max(len(data), 1)
    words, lines = text.split(), [line for line in text.split("\n") if line]
    n_words, n_lines = max(len(words), 1), max(len(lines), 1)
    frequency = Counter(words)
    word_bytes = len(data) - counts[[9, 10, 11, 12, 13, 32]].sum()
    rest = [
        np.log1p(len(words)),
        word_bytes / n_words,
        np.log1p(max(map(len, frequency), default=0)),
        len(frequency) / n_words,
        max(frequency.values(), default=0) / n_words,
        sum(map(str.__eq__, words, words[1:])) / n_words,
        sum(n for word, n in frequency.items() if word.isalpha()) / n_words,
        sum(n for word, n in frequency.items() if word[0].isupper()) / n_words,
        sum(n for word, n in frequency.items() if word.isupper()) / n_words,
        np.log1p(len(lines)),
        np.log1p(len(text) / n_lines),
        len(set(lines)) / n_lines,
    ]
    return np.concatenate([[np.log1p(len(data))], counts @ _MEMBERS / size, counts[_SYMBOLS] / size, rest])


# Trees


@dataclass(frozen=True)
class Forest:
    """Trees of equal depth, flattened: node ``n`` of a tree has the children 2n+1 and 2n+2.

    A row goes to the second child if its value of ``features[tree, n]`` is above
    ``limits[tree, n]``. ``values[tree]`` are those of the leaves, in order.
    """

    base: float
    features: np.ndarray
    limits: np.ndarray
    values: np.ndarray

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of statistics, all trees at once."""
        n_trees, n_nodes = self.features.shape
        trees = np.arange(n_trees)[None, :]
        node = np.zeros((len(rows), n_trees), dtype=np.int64)
        at = np.arange(len(rows))[:, None]
        for _ in range(n_nodes.bit_length()):
            above = rows[at, self.features[trees, node]] > self.limits[trees, node]
            node = 2 * node + 1 + above
        margin = self.base + self.values[trees, node - n_nodes].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def fit(
    rows: np.ndarray,
    labels: np.ndarray,
    trees: int = 80,
    depth: int = 4,
    bins: int = 64,
    rate: float = 0.15,
    penalty: float = 1.0,
    least: float = 1.0,
    weights: np.ndarray | None = None,
) -> Forest:
    """Boosted trees for the logistic loss, split on histograms of at most ``bins`` bins per statistic.

    Each level of a tree adds up the gradients of all nodes, statistics and bins at
    once, and each node takes the split of the greatest gain; a node without a
    gain sends all rows to its first child. ``penalty`` shrinks leaves, ``least`` is
    the least curvature on either side of a split. With labels of one kind only,
    or none, all scores are their share (a half without any). ``weights`` tell how
    often each row counts, once by default.
    """
    n_nodes, n_leaves = 2**depth - 1, 2**depth
    weights = np.ones(len(labels), dtype=np.int64) if weights is None else weights
    share = (labels * weights).sum() / weights.sum() if len(labels) else 0.5
    base = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    if len(labels) == 0 or labels.min() == labels.max():
        return Forest(base, np.zeros((1, n_nodes), dtype=np.int64), np.zeros((1, n_nodes)), np.zeros((1, n_leaves)))
    n, n_features = rows.shape
    edges = [np.unique(_quantiles(rows[:, f], weights, np.linspace(0, 1, bins + 1)[1:-1])) for f in range(n_features)]
    binned = np.stack([np.searchsorted(edges[f], rows[:, f]) for f in range(n_features)], axis=1)
    cells = binned + np.arange(n_features) * bins
    features = np.zeros((trees, n_nodes), dtype=np.int64)
    limits = np.full((trees, n_nodes), np.inf)
    values = np.zeros((trees, n_leaves))
    margin = np.full(n, base)
    for tree in range(trees):
        chance = 1 / (1 + np.exp(-margin))
        gradient, curvature = (chance - labels) * weights, chance * (1 - chance) * weights
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            places = ((node - first)[:, None] * (n_features * bins) + cells).ravel()
            shape = (width, n_features, bins)
            size = width * n_features * bins
            g = np.bincount(places, np.repeat(gradient, n_features), size).reshape(shape).cumsum(axis=2)
            h = np.bincount(places, np.repeat(curvature, n_features), size).reshape(shape).cumsum(axis=2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + penalty) + (all_g - g) ** 2 / (all_h - h + penalty) - all_g**2 / (all_h + penalty)
            gain[(h < least) | (all_h - h < least)] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            for place, cell in enumerate(best.tolist()):
                feature, cut = divmod(cell, bins)
                if gain[place, feature, cut] > 1e-9 and cut < len(edges[feature]):
                    features[tree, first + place] = feature
                    limits[tree, first + place] = edges[feature][cut]
            node = 2 * node + 1 + (rows[np.arange(n), features[tree, node]] > limits[tree, node])
        leaf = node - n_nodes
        values[tree] = -rate * np.bincount(leaf, gradient, n_leaves) / (np.bincount(leaf, curvature, n_leaves) + penalty)
        margin += values[tree, leaf]
    return Forest(base, features, limits, values)


def _quantiles(values: np.ndarray, weights: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Quantiles of the values, each of them taken as often as its weight says."""
    if (weights == 1).all():
        return np.quantile(values, shares)
    order = np.argsort(values, kind="stable")
    values, ends = values[order], weights[order].cumsum()
    places = shares * (ends[-1] - 1)
    low, high = (values[np.searchsorted(ends, at, side="right")] for at in (np.floor(places), np.ceil(places)))
    return low + (high - low) * (places - np.floor(places))


# On Spark


def fold(doc_id: Column) -> Column:
    """Remainder of the id's checksum that sets rows apart; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(0))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", most_rows: int = 20_000) -> Forest:
    """Fits the trees to labelled documents outside the held-out fold.

    About ``most_rows`` of them are used at most, those with the smallest hashes
    of their ids; their statistics are computed by tasks, and only these figures
    come to the driver. Rows without an id or a label are left out, a null text is
    empty, and repeated rows count as often as they occur, but are combined. If
    documents share an id and differ, so that there are more figures than twice
    ``most_rows``, about so many of them are used, those with the smallest hashes are used.
    """
    known = pick(labels, "doc_id", label).withColumnRenamed(label, "label").where("doc_id IS NOT NULL AND label IS NOT NULL")
    trained = known.where(fold(F.col("doc_id")) != 0).select("doc_id", (F.col("label") > 0).cast("int").alias("label"))
    chosen = sampled(trained.groupBy("doc_id", "label").agg(F.count("*").alias("n")), most_rows, "doc_id")
    # About most_rows narrow rows at most: two for an id at most.
    rows = pick(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [statistics(text) for text in texts_of(batch.column(1))]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0),
                    "label": batch.column(2),
                    "n": batch.column(3),
                    "found": pa.array(found, pa.list_(pa.float64())),
                }
            )

    figures = rows.mapInArrow(run, "doc_id long, label int, n long, found array<double>")
    combined = stage_table(figures.groupBy("doc_id", "label", "found").agg(F.sum("n").alias("n")), "quality-figures")
    sample = sampled(combined, 2 * most_rows, "doc_id", "found").toArrow()
    if not sample.num_rows:
        return fit(np.zeros((0, len(NAMES))), np.zeros(0))
    figures = sample["found"].combine_chunks().flatten().to_numpy().reshape(sample.num_rows, -1)
    labels, weights = sample["label"].to_numpy().astype(np.float64), sample["n"].to_numpy()
    # In an order of their own, so that sums do not depend on that of the tasks.
    order = np.lexsort((weights, labels, *figures.T))
    return fit(figures[order], labels[order], weights=weights[order])


def score(docs: DataFrame, forest: Forest, threshold: float = 0.3) -> DataFrame:
    """Scores the whole texts of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    A null text is empty and gets the score of an empty text. A null doc_id stays
    null and counts as held out. Repeated rows repeat, no rows give no rows;
    other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores = _scores(forest, batch.column(1))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "score": pa.array(scores)})

    scored = pick(docs, "doc_id", "text").mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )


def accepted(docs: DataFrame, forest: Forest, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose texts score at least ``threshold``, with all their columns."""
    text = docs.columns.index("text")
    plain = T.StructType([T.StructField(f"c{i}", field.dataType) for i, field in enumerate(docs.schema)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            yield batch.filter(pa.array(_scores(forest, batch.column(text)) >= threshold))

    kept = docs.toDF(*plain.names).mapInArrow(run, plain)
    return kept.toDF(*docs.columns)


def _scores(forest: Forest, texts: pa.Array) -> np.ndarray:
    figures = [statistics(text) for text in texts_of(texts)]
    return forest.scores(np.array(figures).reshape(len(figures), len(NAMES)))
