import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import CLASHING
from pyspark.sql import types as T

from surveysieve.llm import vector_codes, whitening
from surveysieve.llm.vectors import whole_vectors

NAN, INF = float("nan"), float("inf")


def embeddings(spark, rows, extra=()):
    fields = [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
    ]
    fields += [T.StructField(name, T.StringType()) for name in extra]
    return spark.createDataFrame([(*row, *("x" for _ in extra)) for row in rows], T.StructType(fields))


def random_rows(n, width, seed=1, labels=4):
    generator = random.Random(seed)
    rows = []
    for i in range(n):
        vector = [generator.gauss(0, 0.3 + 0.05 * (d % 5)) for d in range(width)]
        rows.append((i * 3 - 7, [float(np.float32(c)) for c in vector], generator.choice([None, *range(labels)])))
    return rows


ODD = [
    (1, None, 1),
    (2, [None] + [0.0] * 31, 1),
    (3, [NAN] * 32, None),
    (4, [INF] + [0.0] * 31, 1),
    (5, [-INF] + [0.0] * 31, 1),
    (6, [], 1),
    (None, [-0.0] * 32, None),
    (8, [0.25] * 32, None),
    (8, [0.25] * 32, 2),
    (8, [-0.251] * 32, 2),
]


def whole(rows):
    """Slow version of ``whole_vectors``."""
    usable = [r for r in rows if r[1] and all(c is not None and np.isfinite(c) for c in r[1])]
    return [(i, [int(np.floor(256 * float(c))) for c in v], label) for i, v, label in usable]


def slow_codes(rows, parts, entries, rounds):
    rows = whole(rows)
    first = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    width = len(first[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in rows]
    books = [[v[p * width : (p + 1) * width] for _, v, _ in first] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry, strict=True)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        moved = []
        for p, book in enumerate(books):
            members = defaultdict(list)
            for vector in cut:
                members[nearest(vector[p], book)[1]].append(vector[p])
            moved.append([
                [sum(c) // len(members[e]) for c in zip(*members[e], strict=True)] if e in members else entry
                for e, entry in enumerate(book)
            ])
        books = moved
    found = [[nearest(vector[p], books[p]) for p in range(parts)] for vector in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = Counter()
    for (_, _, label), error in zip(rows, errors, strict=True):
        by_label[label] += error
    text = ",".join(str(c) for book in books for entry in book for c in entry)
    digest = hashlib.sha256(text.encode()).hexdigest()
    return Counter(
        (i, label, bytes(e for _, e in f), error, by_label[label], digest)
        for (i, _, label), f, error in zip(rows, found, errors, strict=True)
    )


def codes_of(df):
    return Counter((r[0], r[1], bytes(r[2]), *r[3:]) for r in df.collect())


@pytest.mark.parametrize("entries", [1, 5, 64])
def test_codes_equal_the_slow_version(spark, entries):
    rows = random_rows(150, 32) + ODD
    df = embeddings(spark, rows, CLASHING).repartition(5)
    got = vector_codes.compress(df, entries=entries)
    assert got.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]
    assert codes_of(got) == slow_codes(rows, 16, entries, 2)


def test_codes_with_fewer_rows_than_entries_ties_and_copies(spark):
    rows = [(1, [0.5] * 16, 1), (2, [0.5] * 16, 1), (2, [0.5] * 16, 1), (3, [-1.0] * 16, None)]
    assert codes_of(vector_codes.compress(embeddings(spark, rows))) == slow_codes(rows, 16, 64, 2)


def test_codes_of_nothing(spark):
    assert vector_codes.compress(embeddings(spark, [])).collect() == []
    assert vector_codes.compress(embeddings(spark, ODD[:6])).collect() == []


def test_entries_without_parts_stay_and_sums_round_down(spark):
    # Entry 1 repeats entry 0, so it never wins a tie; the mean of -3 and -4 is -4.
    rows = [(1, [-3 / 256] * 16, 0), (2, [-3 / 256] * 16, 0), (3, [-4 / 256] * 16, 0), (4, [9.0] * 16, 0)]
    vectors = whole_vectors(embeddings(spark, rows), "vec_id")
    books = vector_codes.train(vectors, entries=2, rounds=1)
    assert books.entries[0].tolist() == [[(-10 + 9 * 256) // 4], [-3]]


def test_vectors_that_cannot_be_coded_are_errors(spark):
    for rows in ([(1, [0.0] * 17, 0)], [(1, [0.0] * 16, 0), (2, [0.0] * 32, 0)], [(1, [6e5] * 16, 0)]):
        with pytest.raises(Exception, match="components|component"):
            vector_codes.compress(embeddings(spark, rows)).collect()
    with pytest.raises(ValueError):
        vector_codes.compress(embeddings(spark, ODD), entries=257)


def slow_whitening(rows, wanted=4):
    rows = whole(rows)
    distinct = np.array(sorted({tuple(v) for _, v, _ in rows}), dtype=float)
    mean = distinct.mean(axis=0)
    values, vectors = np.linalg.eigh((distinct - mean).T @ (distinct - mean) / len(distinct))
    return rows, distinct, mean, values[::-1], vectors[:, ::-1][:, :wanted]


def check_whitening(spark, rows, wanted=4):
    df = embeddings(spark, rows, CLASHING).repartition(3)
    got, about, components, off = whitening.whiten(df, wanted)
    usable, distinct, mean, values, vectors = slow_whitening(rows, wanted)
    assert about.n == len(distinct)
    np.testing.assert_allclose(components.values, values[:wanted], rtol=1e-12)
    np.testing.assert_allclose(components.trace, values.sum(), rtol=1e-12)
    assert off < 1e-9
    sign = np.sign((components.vectors * vectors).sum(axis=0))
    expected = Counter()
    for i, v, _ in usable:
        deviation = sum((about.n * c - s) ** 2 for c, s in zip(v, about.sums.tolist(), strict=True))
        white = (np.array(v) - mean) @ vectors * sign / np.sqrt(values[:wanted])
        for k, w in enumerate(white.tolist(), 1):
            expected[i, k, deviation, round(w, 7) + 0.0] += 1
    assert Counter((r[0], r[1], r[2], round(r[3], 7) + 0.0) for r in got.collect()) == expected
    return components


@pytest.mark.parametrize("width", [5, 32, 48])
def test_whitening_equals_the_full_decomposition(spark, width):
    rows = random_rows(300, width, seed=width)
    check_whitening(spark, rows + rows[:40] + [(None, [0.125] * width, None), (7, None, 1), (8, [NAN] * width, 1)])


def test_whitening_counts_equal_vectors_once(spark):
    rows = random_rows(60, 16)
    _, once, _, _ = whitening.whiten(embeddings(spark, rows))
    _, twice, components, _ = whitening.whiten(embeddings(spark, rows + rows[:1] * 500))
    assert twice.n == once.n == 60 and (twice.sums == once.sums).all()


def test_whitening_where_little_or_nothing_varies(spark):
    for rows in ([], ODD[:6], [(1, [0.5] * 8, 0)] * 3):
        df, about, components, off = whitening.whiten(embeddings(spark, rows))
        assert df.collect() == [] and about is components is None and off == 0.0
        assert df.columns == ["vec_id", "component", "deviation", "whitened"]
    line = [(i, [i / 8, i / 4, 0.0], 0) for i in range(5)]
    assert {r["component"] for r in whitening.whiten(embeddings(spark, line))[0].collect()} == {1}
    with pytest.raises(Exception, match="components"):
        whitening.whiten(embeddings(spark, [(1, [0.0], 0), (2, [0.0, 1.0], 0)]))


def test_filter_separates_close_eigenvalues_in_few_passes():
    generator = np.random.default_rng(5)
    spectrum = np.concatenate([[1.0, 0.999, 0.998, 0.997], np.linspace(0.996, 0.5, 196)])
    basis = np.linalg.qr(generator.standard_normal((200, 200)))[0]
    covariance = (basis * spectrum) @ basis.T
    passes = []

    def product(block):
        passes.append(block.shape)
        return covariance @ block

    vectors, values, angles = whitening.leading_components(product, 200, 4, tolerance=1e-9)
    np.testing.assert_allclose(values, spectrum[:4], atol=1e-12)
    assert np.abs(np.abs((vectors * basis[:, :4]).sum(axis=0)) - 1).max() < 1e-12
    assert (angles < 1e-8).all() and len(passes) < 400


def test_an_eigenvalue_that_occurs_twice_is_certified_by_its_residual():
    spectrum = np.array([2.0, 2.0, *np.linspace(1, 0, 58)])
    vectors, values, _ = whitening.leading_components(lambda block: spectrum[:, None] * block, 60, 1)
    assert values[0] == pytest.approx(2.0, abs=1e-12)
    assert np.linalg.norm(vectors[2:]) < 1e-10


def test_deviations_beyond_64_bits_are_null():
    small = np.array([[3, -4]])
    large = np.array([[2**40, 0], [2**31, 1]])
    assert whitening._squared_lengths(small).to_pylist() == [25]
    assert whitening._squared_lengths(large).to_pylist() == [None, 2**62 + 1]
