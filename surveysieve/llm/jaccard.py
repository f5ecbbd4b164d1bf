"""Jaccard similarity join of word shingles by chosen paths."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveysieve.llm.common import packed, pick, slices, texts_of, unpacked
from surveysieve.llm.hashing import shingles
from surveysieve.operators.skew import SMALL_ROWS, join_per_key
from surveysieve.sources.sinks import stage_table

# Tokens that stand for a set: the least hash under each of so many functions.
TOKENS = 64
# Sets that are compared with each other without splitting them further; nodes of one set cost nothing.
SMALL = 2_000
DEPTH = 6
CHILDREN = 2
TARGET_RECALL = 0.999999
# Of a block of sets whose texts are compared exactly.
BLOCK_SETS = 512
BLOCK_SHINGLES = 1_000_000
SEED = 20240101

_MULTIPLIERS = np.array([random.Random(SEED + i).getrandbits(64) | 1 for i in range(TOKENS)], dtype=np.uint64)


def tokens_of(found: np.ndarray) -> np.ndarray:
    """The least hash of a set under each function, 32 bits of it; zeros for an empty set."""
    least = np.full(TOKENS, np.iinfo(np.uint64).max, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for start in range(0, len(found), 8192):
            least = np.minimum(least, (found[start : start + 8192, None] * _MULTIPLIERS[None, :]).min(axis=0))
    return (least >> np.uint64(32)).astype("<u4") if len(found) else np.zeros(TOKENS, dtype="<u4")


def lost(similarity: float, n_tokens: int, depth: int) -> float:
    """Probability that a pair of this similarity meets in no node, from ``n_tokens`` root tokens and through ``depth`` splits.

    Of all tokens of a pair some number agree. Given that number, a path goes on in
    a child with the share of agreeing tokens, and ends if no child goes on. A pair
    that agrees in too few tokens for a comparison of sketches is lost as well.
    """
    total = 0.0
    for agreeing in range(TOKENS + 1):
        chance = math.comb(TOKENS, agreeing) * similarity**agreeing * (1 - similarity) ** (TOKENS - agreeing)
        if agreeing < least_matches(similarity):
            total += chance
            continue
        ended = 0.0
        for _ in range(depth):
            ended = (1 - agreeing / TOKENS * (1 - ended)) ** CHILDREN
        shared = range(max(0, n_tokens + agreeing - TOKENS), min(agreeing, n_tokens) + 1)
        ways = (math.comb(agreeing, k) * math.comb(TOKENS - agreeing, n_tokens - k) * ended**k for k in shared)
        total += chance * sum(ways) / math.comb(TOKENS, n_tokens)
    return total


def needed_tokens(similarity: float, target: float, depth: int) -> int | None:
    """The least number of root tokens by which a pair is found with probability ``target``, if there is one."""
    return next((n for n in range(1, TOKENS + 1) if lost(similarity, n, depth) <= 1 - target), None)


def root_tokens(similarity: float, target: float, seed: int = SEED, depth: int = DEPTH) -> list[list[int]]:
    """Sampled tokens of each run: runs are added until a pair at the threshold is found with probability ``target``.

    That counts what ``depth`` splits of nodes may lose. Each token is sampled with probability 1 / (similarity * TOKENS), so a similar
    pair can expect to share one per run; a token counts in the first run that
    samples it.
    """
    generator, runs, seen = random.Random(seed), [], set()
    needed = needed_tokens(similarity, target, depth)
    if needed is None:
        raise ValueError(f"a recall of {target} at similarity {similarity} needs more than {TOKENS} tokens")
    while len(seen) < needed:
        run = [i for i in range(TOKENS) if generator.random() < 1 / (similarity * TOKENS) and i not in seen]
        seen.update(run)
        if run:
            runs.append(run)
    return runs


_SETS = "doc_id long, text_key long, set_key binary, n int, tokens binary"


def _text_key() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _id_key() -> Column:
    return F.coalesce("doc_id", F.lit(-(2**63)))


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, text_key, set_key (equal for equal sets), number of shingles and tokens of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys, counts, tokens = [], [], []
            for text in texts_of(batch.column(1)):
                found = shingles(text, size)
                keys.append(xxhash.xxh3_128_digest(found.tobytes()))
                counts.append(len(found))
                tokens.append(tokens_of(found).tobytes())
            columns = [
                batch.column(0),
                batch.column(2),
                pa.array(keys, pa.binary()),
                pa.array(counts, pa.int32()),
                pa.array(tokens, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "set_key", "n", "tokens"])

    return pick(docs, "doc_id", "text").withColumn("text_key", _text_key()).mapInArrow(run, _SETS)


def _distinct(sets: DataFrame) -> DataFrame:
    """One row per distinct set: its copies, its smallest doc_id, and the key of a text that has it."""
    return sets.groupBy("set_key", "n", "tokens").agg(
        F.count("*").alias("copies"),
        F.min("doc_id").alias("first_id"),
        F.coalesce(F.min_by("text_key", "doc_id"), F.min("text_key")).alias("text_key"),
    )


# Splitting


def _root_nodes(distinct: DataFrame, runs: list[list[int]]) -> DataFrame:
    nodes = [
        F.xxhash64(F.lit(number), F.lit(token), F.substring("tokens", 4 * token + 1, 4))
        for number, run in enumerate(runs)
        for token in run
    ]
    # The low byte of each token is enough to compare sets roughly and to split them further.
    low = F.concat(*(F.substring("tokens", 4 * token + 1, 1) for token in range(TOKENS)))
    return distinct.where("n > 0").select(F.explode(F.array(*nodes)).alias("node"), "set_key", "n", low.alias("sketch"))


def _split(rows: DataFrame) -> DataFrame:
    """Children of nodes: each node samples tokens of its own, and its sets part by their values there."""
    children = []
    for child in range(CHILDREN):
        token = F.pmod(F.xxhash64("node", F.lit(child)), F.lit(TOKENS)).cast("int")
        children.append(F.xxhash64("node", F.lit(child), F.substring(F.col("sketch"), token + 1, F.lit(1))))
    return rows.select(F.explode(F.array(*children)).alias("node"), "set_key", "n", "sketch", F.col("size").alias("parent"))


def _in_blocks(rows: DataFrame, small: int) -> DataFrame:
    """Rows of nodes that no longer part: each pair of blocks of a node is a node."""
    blocks = F.ceil(F.col("size") / small).cast("int")
    own = F.pmod(F.xxhash64("set_key"), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = rows.select("*", blocks.alias("blocks"), own.alias("own")).select("*", other.alias("other"))
    node = F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other"))
    return met.select(node.alias("node"), "set_key", "n", "sketch")


def candidates(distinct: DataFrame, similarity: float, target: float, small: int = SMALL, depth: int = DEPTH) -> DataFrame:
    """Links (a, b) between set keys that connect all sets that may be similar.

    Sets are split by sampled tokens until a node holds at most ``small`` of them;
    these are compared by their sketches. Of each node only links that connect its
    alike sets are returned, one fewer than there are sets. Nodes that are still
    large at ``depth`` are compared block by block, and so are those of near copies, which
    splits hardly part, where that copies their sets no more often than splits may. Where so many splits lose too
    many pairs for ``target``, there are fewer.
    """
    while depth and needed_tokens(similarity, target, depth) is None:
        depth -= 1
    rows = _root_nodes(distinct, root_tokens(similarity, target, depth=depth)).withColumn("parent", F.lit(None).cast("long"))
    found = None
    for level in range(depth + 1):
        sizes = rows.groupBy("node").agg(F.count("*").alias("size"), F.max("parent").alias("parent"))
        blocks = F.ceil(F.col("size") / small)
        alike = (2 * F.col("size") > F.coalesce("parent", 2 * F.col("size"))) & (blocks <= CHILDREN ** (depth - level))
        last = alike | (blocks <= CHILDREN) | F.lit(level == depth)
        large = stage_table(sizes.where(F.col("size") > small).select("node", "size", last.alias("last")), "jaccard-large")
        counts = {row["last"]: row["count"] for row in large.groupBy("last").count().collect()}
        n_large = sum(counts.values())
        if not n_large:
            links = _compared(rows, similarity)
            return links if found is None else found.unionByName(links)
        # One row per large node; beyond that size, large nodes are parted by a join that Spark can balance.
        sought = F.broadcast(large) if n_large <= SMALL_ROWS else large
        links = _compared(rows.join(sought, "node", "left_anti"), similarity)
        found = links if found is None else found.unionByName(links)
        within = rows.join(sought, "node")
        if True in counts:
            found = found.unionByName(_compared(_in_blocks(within.where("last"), small), similarity))
        if False not in counts:
            return found
        rows = stage_table(_split(within.where("NOT last")), "jaccard-split")


def least_matches(similarity: float) -> int:
    """Equal bytes that sketches of similar sets have at least, six standard deviations below the mean."""
    spread = math.sqrt(TOKENS * similarity * (1 - similarity))
    return max(1, math.floor(TOKENS * similarity - 6 * spread))


def _compared(rows: DataFrame, similarity: float) -> DataFrame:
    least, share = least_matches(similarity), float(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in repeated(batches):
            keys = group.column(1)
            sketches = np.frombuffer(b"".join(group.column(3).to_pylist()), dtype=np.uint8).reshape(len(keys), -1)
            roots = alike_roots(group.column(2).to_numpy().astype(np.float64), sketches, least, share)
            hung = np.flatnonzero(roots != np.arange(len(keys)))
            if len(hung):
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(roots[hung])), keys.take(pa.array(hung))], ["a", "b"])

    return _by(rows.select("node", "set_key", "n", "sketch"), "node").mapInArrow(run, "a binary, b binary")


def alike_roots(sizes: np.ndarray, sketches: np.ndarray, least: int, share: float) -> np.ndarray:
    """For each set of a node the first one that it is connected to by alike sets, whose sketches have ``least`` equal bytes.

    Sets that are known to be connected are not compared with each other, so a
    node of near copies takes a few passes over it.
    """
    tokens = np.ascontiguousarray(sketches.T)

    def alike(rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        if len(rows) * len(columns) <= 1024:
            found = (sketches[rows, None, :] == sketches[None, columns, :]).sum(axis=2) >= least
        else:
            equal = np.zeros((len(rows), len(columns)), dtype=np.uint8)
            for own, other in zip(tokens[:, rows], tokens[:, columns], strict=True):
                equal += own[:, None] == other[None, :]
            found = equal >= least
        small, large = np.minimum(sizes[rows, None], sizes[None, columns]), np.maximum(sizes[rows, None], sizes[None, columns])
        return found & (small >= share * large - 1e-9)

    n = len(sizes)
    roots, joined, open_ = np.arange(n), np.zeros(n, dtype=bool), np.ones(n, dtype=bool)
    while open_.any():
        # The sets of a component that has begun, else new ones, meet all sets that are open and not of that component.
        begun = np.flatnonzero(joined & open_)
        rows = begun[roots[begun] == roots[begun[0]]] if len(begun) else np.flatnonzero(open_)
        columns = np.flatnonzero(open_ & (roots != roots[rows[0]])) if len(begun) else rows
        if not len(columns):
            open_[rows] = False
            continue
        rows = rows[:64]
        row, column = np.nonzero(alike(rows, columns))
        a, b = rows[row], columns[column]
        linked = a != b
        joined[a[linked]] = joined[b[linked]] = True
        roots = connected(roots, a, b)
        open_[rows] = False
    return roots


def connected(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``roots``, the least place of each place's component, after the places ``a`` are linked to ``b``."""
    a, b = roots[a], roots[b]
    while (apart := a != b).any():
        a, b = a[apart], b[apart]
        hung = np.arange(len(roots))
        np.minimum.at(hung, np.maximum(a, b), np.minimum(a, b))
        while (hung[hung] != hung).any():
            hung = hung[hung]
        roots, a, b = hung[roots], hung[a], hung[b]
    return roots


def _by(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows with equal keys next to each other, in a defined order."""
    return rows.repartition(*keys).sortWithinPartitions(*keys, "set_key")


def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that share their first column, a number, with others; equal ones follow each other."""
    pending = None
    for batch in batches:
        if pending is not None:
            batch = pa.concat_batches([pending, batch])
        if not batch.num_rows:
            continue
        numbers = batch.column(0).to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], numbers[1:] != numbers[:-1]]))
        sizes = np.diff(np.append(starts, len(numbers)))
        # The last run may go on in the next batch.
        for place in np.flatnonzero(sizes[:-1] > 1).tolist():
            yield batch.slice(int(starts[place]), int(sizes[place]))
        pending = batch.slice(int(starts[-1]))
    if pending is not None and pending.num_rows > 1:
        yield pending


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[list]]:
    """Columns of the rows with equal first ``keys`` columns, which follow each other."""
    current, columns = None, []
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if row[:keys] != current:
                if current is not None:
                    yield columns
                current, columns = row[:keys], [[] for _ in row]
            for column, value in zip(columns, row, strict=True):
                column.append(value)
    if current is not None:
        yield columns


# Components


def components(links: DataFrame) -> DataFrame:
    """node and root (the least node connected to it) for every node of the links (a, b).

    Each round hangs the larger neighbours of every node below its least
    neighbour, then the smaller ones, until nothing changes. Hubs are salted.
    """
    edges = stage_table(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _to_least(both).where("neighbour > node").select(F.col("neighbour").alias("a"), F.col("least").alias("b"))
        middle = stage_table(large.distinct(), "links")
        small = _to_least(middle)
        hung = small.select(F.col("neighbour").alias("a"), F.col("least").alias("b"))
        own = small.select(F.col("node").alias("a"), F.col("least").alias("b"))
        edges = stage_table(hung.unionByName(own).where("a != b").distinct(), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")).first()
    return row["n"], row["sum"]


def _to_least(directed: DataFrame) -> DataFrame:
    """node, neighbour, and the least of the node and its neighbours."""
    edges = directed.select(F.col("a").alias("node"), F.col("b").alias("neighbour"))
    least = edges.groupBy("node").agg(F.count("*").alias("degree"), F.min("neighbour").alias("least"))
    least = least.withColumn("least", F.least("node", "least"))
    return join_per_key(edges, least, ["node"], "degree", F.col("neighbour"))


# Exact links

_EXACT = "a binary, b binary, links long"


def exact_links(docs: DataFrame, members: DataFrame, similarity: float, size: int) -> DataFrame:
    """Compares the whole texts of ``members`` (set_key, root, n, copies, id_key, text_key) within each root.

    Returns rows (a, null, links), to be summed: documents with a similar but
    different set; and (a, b, 0): similar sets that connect all similar ones.
    """
    limit = Fraction(similarity).limit_denominator(1000)
    totals = members.groupBy("root").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    sized = join_per_key(members, totals, ["root"], "sets", F.col("set_key")).withColumn("blocks", blocks)
    texts = pick(docs, "doc_id", "text").select(
        _id_key().alias("id_key"), _text_key().alias("text_key"), F.coalesce("text", F.lit("")).alias("text")
    )
    # Repeated rows of a document are combined before they are sent.
    texts = texts.groupBy("id_key", "text_key").agg(F.first("text").alias("text"))
    with_text = sized.join(texts, ["id_key", "text_key"])
    own = F.pmod(F.xxhash64("set_key"), F.col("blocks")).cast("int")
    met = with_text.select("*", own.alias("own")).select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = met.select(
        "root", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "set_key", "copies", "text"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, low, high, own, keys, copies, texts in groups(batches, 3):
            found = [shingles(text, size) for text in texts]
            side = np.array(own) == low[0]
            a, b = similar_pairs(found, limit, side if low[0] != high[0] else None)
            if not len(a):
                continue
            weights = np.array(copies, dtype=np.int64)
            links = np.zeros(len(keys), dtype=np.int64)
            np.add.at(links, a, weights[b])
            np.add.at(links, b, weights[a])
            linked = np.flatnonzero(links)
            roots = connected(np.arange(len(keys)), a, b)
            hung = [(roots[x], x) for x in linked.tolist() if roots[x] != x]
            yield pa.RecordBatch.from_pydict(
                {
                    "a": pa.array([keys[x] for x in linked] + [keys[r] for r, _ in hung], pa.binary()),
                    "b": pa.array([None] * len(linked) + [keys[x] for _, x in hung], pa.binary()),
                    "links": pa.array([*links[linked].tolist(), *[0] * len(hung)], pa.int64()),
                }
            )

    return _by(rows, "root", "low", "high").mapInArrow(run, _EXACT)


def similar_pairs(sets: list[np.ndarray], limit: Fraction, side: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places a < b of all pairs with a Jaccard similarity of at least ``limit``; with ``side``, pairs across sides only."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    rows, columns = (np.arange(len(sets)),) * 2 if side is None else (np.flatnonzero(side), np.flatnonzero(~side))
    common = _common(sets, rows, columns)
    union = sizes[rows, None] + sizes[None, columns] - common
    alike = (common * limit.denominator >= union * limit.numerator) & (common > 0)
    a, b = np.nonzero(np.triu(alike, 1) if side is None else alike)
    a, b = rows[a], columns[b]
    return np.minimum(a, b), np.maximum(a, b)


def _common(
    sets: list[np.ndarray], rows: np.ndarray | None = None, columns: np.ndarray | None = None, width: int = 4096
) -> np.ndarray:
    """Shared elements of the sets at ``rows`` with those at ``columns``; of all sets without these."""
    m = len(sets)
    rows, columns = (np.arange(m) if places is None else places for places in (rows, columns))
    if m <= 8:
        common = [[len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for b in columns] for a in rows]
        return np.array(common, dtype=np.int64).reshape(len(rows), len(columns))
    values = np.concatenate(sets)
    owners = np.repeat(np.arange(m), [len(s) for s in sets])
    _, elements, counts = np.unique(values, return_inverse=True, return_counts=True)
    shared = counts[elements] > 1
    number = np.cumsum(counts > 1) - 1
    elements, owners = number[elements[shared]], owners[shared]
    order = np.argsort(elements, kind="stable")
    elements, owners = elements[order], owners[order]
    out = np.zeros((len(rows), len(columns)), dtype=np.float64)
    for start in range(0, int((counts > 1).sum()), width):
        a, b = np.searchsorted(elements, [start, start + width])
        dense = np.zeros((m, width), dtype=np.float32)
        dense[owners[a:b], elements[a:b] - start] = 1
        out += dense[rows] @ dense[columns].T
    return out.astype(np.int64)


# The join


def _classes(docs: DataFrame, similarity: float, size: int, target: float, small: int, depth: int) -> tuple[DataFrame, DataFrame]:
    """Sets of the documents, and for each distinct set its class root, first id of the class, links and copies."""
    sets = stage_table(shingle_sets(docs, size), "jaccard-sets")
    distinct = stage_table(_distinct(sets), "jaccard-distinct")
    rough = stage_table(components(candidates(distinct, similarity, target, small, depth)), "jaccard-rough")
    members = distinct.drop("tokens").join(rough.withColumnRenamed("node", "set_key"), "set_key")
    members = members.select("root", "set_key", "n", "copies", F.coalesce("first_id", F.lit(-(2**63))).alias("id_key"), "text_key")
    exact = stage_table(exact_links(docs, members, similarity, size), "jaccard-exact")
    roots = components(exact.where("b IS NOT NULL").select("a", "b")).select(F.col("node").alias("set_key"), "root")
    links = exact.where("b IS NULL").groupBy(F.col("a").alias("set_key")).agg(F.sum("links").alias("links"))
    linked = stage_table(
        distinct.select("set_key", "copies", "first_id", "text_key").join(roots, "set_key", "left").join(links, "set_key", "left"),
        "jaccard-linked",
    )
    firsts = linked.where("root IS NOT NULL").groupBy("root").agg(F.count("*").alias("sets"), F.min("first_id").alias("class_id"))
    grouped = join_per_key(linked.where("root IS NOT NULL"), firsts, ["root"], "sets", F.col("set_key")).drop("sets")
    alone = linked.where("root IS NULL").select(
        *(F.col("set_key") if c == "root" else F.col(c) for c in linked.columns), F.col("first_id").alias("class_id")
    )
    alone = alone.toDF(*linked.columns, "class_id")
    classes = grouped.select(*alone.columns).unionByName(alone)
    return sets, classes.withColumn("n_links", F.coalesce("links", F.lit(0)) + F.col("copies") - 1)


def similarity_classes(
    docs: DataFrame,
    similarity: float = 0.8,
    size: int = 5,
    target: float = TARGET_RECALL,
    small: int = SMALL,
    depth: int = DEPTH,
) -> DataFrame:
    """Classes of ``docs`` (doc_id, text) linked by a Jaccard similarity of their word shingles of at least ``similarity``.

    One row per document: ``class_id`` (the smallest doc_id of all documents
    that are connected by links), ``n_links`` (documents similar to this one) and
    ``n_copies`` (documents with the same set of shingles, this one included).

    Documents are compared by the set of all runs of ``size`` words between ASCII
    white space. Equal sets are merged first. Runs of chosen paths are repeated
    until a pair at the threshold meets with probability ``target``, also where
    nodes are split. What they
    find is connected to rough components, inside which whole texts are compared
    exactly, so a link can only be lost if no path connects its two sides.

    A text of fewer words is one run; texts without words (nulls too) are equal
    to each other and similar to nothing else. Null doc_ids are ignored in
    class_id, which is null if a class has no other. Repeated rows are copies. No
    rows give no rows. Other columns are ignored.
    """
    sets, classes = _classes(docs, similarity, size, target, small, depth)
    info = classes.select("set_key", "class_id", "n_links", F.col("copies").alias("n_copies"))
    joined = join_per_key(sets.select("doc_id", "set_key"), info, ["set_key"], "n_copies", F.col("doc_id"))
    return joined.select("doc_id", "class_id", "n_links", "n_copies")


def drop_similar(docs: DataFrame, similarity: float = 0.8, size: int = 5, target: float = TARGET_RECALL) -> DataFrame:
    """One row of ``docs`` for each class of ``similarity_classes``, with all its columns: that with the smallest doc_id.

    Of several rows with that doc_id, one stays.
    """
    sets, classes = _classes(docs, similarity, size, target, SMALL, DEPTH)
    first = F.min(F.struct(F.col("first_id").isNull().alias("no_id"), "first_id", "set_key", "text_key")).alias("first")
    firsts = classes.groupBy("root").agg(first)
    kept = firsts.select(F.coalesce("first.first_id", F.lit(-(2**63))).alias("id_key"), "first.text_key")
    rows = packed(docs, "doc_id", "text").select(_id_key().alias("id_key"), _text_key().alias("text_key"), "row")
    chosen = rows.join(kept, ["id_key", "text_key"])
    once = Window.partitionBy("id_key", "text_key").orderBy("text_key")
    return unpacked(chosen.withColumn("place", F.row_number().over(once)).where("place = 1"), docs)
