"""The classifier, and the whole pipeline."""

import os
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import CLASHING, TEXTS, documents, near_copy, prose
from test_llm_copies import brute_classes, brute_copies

import corpus_pipeline
from surveysieve.llm import quality

SF_DIR = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no generated tables")


def walk(forest, row):
    """One row, tree by tree and node by node."""
    margin = forest.base
    n_nodes = forest.features.shape[1]
    for features, limits, values in zip(forest.features, forest.limits, forest.values):
        node = 0
        while node < n_nodes:
            node = 2 * node + (2 if row[features[node]] > limits[node] else 1)
        margin += values[node - n_nodes]
    return 1 / (1 + np.exp(-margin))


def test_flat_trees_equal_a_walk():
    generator = np.random.default_rng(2)
    rows = generator.normal(size=(500, 4))
    labels = (rows[:, 0] * rows[:, 1] + 0.1 * generator.normal(size=500) > 0).astype(float)
    forest = quality.fit(rows, labels, trees=30, depth=3, bins=16)
    scores = forest.scores(rows)
    assert np.allclose(scores, [walk(forest, row) for row in rows])
    assert ((scores >= 0.5) == labels).mean() > 0.9


def test_first_split_is_the_best_one():
    """Against trying every feature and every edge, with plain sums."""
    generator = np.random.default_rng(8)
    rows = generator.integers(0, 6, size=(200, 3)).astype(float)
    labels = ((rows[:, 1] > 2) ^ (generator.random(200) < 0.1)).astype(float)
    forest = quality.fit(rows, labels, trees=1, depth=1, bins=64, penalty=1.0, least=0.0)
    share = labels.mean()
    gradient, curvature = share - labels, np.full(200, share * (1 - share))

    def gain(feature, limit):
        low = rows[:, feature] <= limit
        return sum(gradient[side].sum() ** 2 / (curvature[side].sum() + 1) for side in (low, ~low))

    best = max(gain(f, limit) for f in range(3) for limit in range(6))
    assert gain(forest.features[0, 0], forest.limits[0, 0]) == pytest.approx(best)


def test_labels_of_one_kind():
    for labels in (np.zeros(0), np.ones(5), np.zeros(5)):
        forest = quality.fit(np.zeros((len(labels), 3)), labels)
        assert np.allclose(forest.scores(np.zeros((4, 3))), labels.mean() if len(labels) else 0.5, atol=1e-5)
    assert len(forest.scores(np.zeros((0, 3)))) == 0


def test_statistics_of_any_text():
    for _, text in TEXTS:
        figures = quality.statistics(text or "")
        assert len(figures) == len(quality.NAMES) and np.isfinite(figures).all()
    named = dict(zip(quality.NAMES, quality.statistics("Ab, ab ab\n\n#x ab"), strict=True))
    assert named["repeated_next"] == pytest.approx(1 / 5) and named["top_word"] == pytest.approx(3 / 5)
    assert named["share_#"] == pytest.approx(1 / 16) and named["share_upper"] == pytest.approx(1 / 16)


@needs_tables
def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "labels"))
    forest = quality.train(docs, labels)
    rows = quality.score(docs, forest).join(labels, "doc_id").collect()
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0) for row in rows)
    held_out = [row for row in rows if row.held_out]
    assert len(held_out) > 40
    assert np.mean([row.predicted == row.quality for row in held_out]) >= 0.95
    assert all(0 <= row.score <= 1 and row.predicted == (row.score >= 0.3) for row in rows)


@needs_tables
def test_held_out_labels_are_not_read(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "labels"))
    from pyspark.sql import functions as F

    turned = labels.withColumn("quality", F.when(quality.fold(F.col("doc_id")) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, other = quality.train(docs, labels), quality.train(docs, turned)
    assert np.array_equal(one.values, other.values) and np.array_equal(one.limits, other.limits)


def test_scores_of_edge_cases(spark, edge_docs, no_docs):
    rows = [(i, i % 2, 0) for i in range(12)] + [(None, 1, 0), (3, None, 0), (2, 0, 0)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, score int")
    forest = quality.train(edge_docs, labels)
    found = quality.score(edge_docs, forest).collect()
    assert Counter(row.doc_id for row in found) == Counter(doc_id for doc_id, _ in TEXTS)
    assert all(0 <= row.score <= 1 for row in found)
    by_id = {row.doc_id: row for row in found}
    assert by_id[4].score == by_id[5].score and by_id[None].held_out
    assert quality.score(no_docs, forest).count() == 0
    assert quality.train(no_docs, labels).scores(np.zeros((1, len(quality.NAMES))))[0] == pytest.approx(0.5)
    assert quality.train(edge_docs, labels.limit(0)).scores(np.zeros((1, len(quality.NAMES))))[0] == pytest.approx(0.5)
    kept = quality.accepted(edge_docs, forest, 0.0)
    assert kept.columns == edge_docs.columns and kept.count() == len(TEXTS)
    assert quality.accepted(edge_docs, forest, 1.1).count() == 0


def test_sample_is_bounded(spark):
    docs = documents(spark, [(i, f"text {i} " * (1 + i % 9)) for i in range(300)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, quality int")
    quality.train(docs, labels, most_rows=50)


def test_weights_equal_repeated_rows():
    generator = np.random.default_rng(5)
    rows, weights = generator.normal(size=(200, 4)), generator.integers(1, 6, size=200)
    labels = (rows[:, 0] + generator.normal(size=200) > 0).astype(float)
    one = quality.fit(rows, labels, trees=5, weights=weights)
    other = quality.fit(np.repeat(rows, weights, axis=0), np.repeat(labels, weights), trees=5)
    assert np.array_equal(one.features, other.features)
    assert np.allclose(one.limits, other.limits) and np.allclose(one.values, other.values) and one.base == pytest.approx(other.base)


@pytest.mark.parametrize("differ", [False, True])
def test_repeated_ids_do_not_come_to_the_driver_one_by_one(spark, monkeypatch, differ):
    came, fit = [], quality.fit
    monkeypatch.setattr(quality, "fit", lambda rows, labels, **given: came.append((len(rows), given["weights"].sum())) or fit(rows, labels, **given))
    often = next(i for i in range(1_000, 1_100) if zlib.crc32(str(i).encode()) % 5)
    docs = documents(spark, [(i, f"text {i} " * (1 + i % 9)) for i in range(60)] + [(often, "word " * (i * differ + 1)) for i in range(200)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(often, 1)] * 100, "doc_id long, quality int")
    quality.train(docs, labels, most_rows=50)
    (n_rows, total), = came
    assert n_rows <= 130 and total > (1_000 if differ else 20_000)


# The pipeline


def pipeline_tables(spark, folder):
    good = [prose(i, 80 + i) for i in range(40)]
    texts = good + good[:10] + [near_copy(text, i, 2) for i, text in enumerate(good[:15])]
    texts += ["junk " * (20 + i) for i in range(30)] + ["", None]
    rows = [(i * 3, text) for i, text in enumerate(texts)]
    # Files cannot hold names that differ in case only.
    extra = [name for name in CLASHING if name != "Text"]
    documents(spark, rows, extra).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(not (text or "junk").startswith("junk"))) for i, text in rows]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    return rows


def test_pipeline_stages_against_brute_force(spark, tmp_path):
    folder = str(tmp_path)
    rows = pipeline_tables(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "n-gram Jaccard join", "packing"]
    texts = dict(rows)
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = sorted(row.doc_id for row in docs.select("doc_id").collect())
        out = stage(spark, docs, folder)
        if number == 3:
            break
        assert out.columns == docs.columns
        out.write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        after = sorted(row.doc_id for row in docs.select("doc_id").collect())
        current = [(i, texts[i]) for i in before]
        if number == 0:
            forest = quality.train(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
            figures = [quality.statistics(texts[i] or "") for i in before]
            expected = [i for i, row in zip(before, figures) if walk(forest, row) >= 0.3]
            assert all(not (texts[i] or "").startswith("junk") for i in expected) and len(expected) >= 60
        elif number == 1:
            expected = sorted(key[0] for key in brute_copies(current).elements() if key[3])
            assert len(expected) < len(before)
        else:
            expected = sorted(min(current[m][0] for m in members) for members in brute_classes(current)[1])
            assert len(expected) < len(before)
        assert after == expected
    lengths = Counter()
    for row in out.collect():
        lengths[row.doc_id] += row.length
        assert row.sequence_length <= 2048
    assert sorted(lengths) == after
    whole = {row.doc_id: row.doc_tokens for row in out.collect()}
    assert lengths == whole
    ran = corpus_pipeline.run(spark, folder)
    assert {row.doc_id for row in ran.select("doc_id").distinct().collect()} == set(after)


def test_pipeline_without_rows(spark, tmp_path):
    folder = str(tmp_path)
    pipeline_tables(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0
