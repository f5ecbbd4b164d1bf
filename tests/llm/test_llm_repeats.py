import os
import random
from collections import Counter

import numpy as np
import pytest
from cases import LONG, TEXTS, documents, edge_documents, near_copy, prose

from surveysieve.llm import bwt, suffix_dedup
from surveysieve.sources.sinks import shared_folder


def slow_repeats(strings, often, length):
    """(string, offset) of every run of ``length`` bytes that occurs more than once."""
    counts = Counter()
    for string, many in zip(strings, often, strict=True):
        for i in range(len(string) - length + 1):
            counts[string[i : i + length]] += 2 if many else 1
    return {
        (k, i)
        for k, string in enumerate(strings)
        for i in range(len(string) - length + 1)
        if counts[string[i : i + length]] > 1
    }


def slow_kept(texts, length):
    """(spans, kept) of each text."""
    raw = [(text or "").encode() for text in texts]
    marked = [np.zeros(len(text), dtype=bool) for text in raw]
    for k, i in slow_repeats(raw, [False] * len(raw), length):
        marked[k][i : i + length] = True
    found = []
    for text, mark in zip(raw, marked, strict=True):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], mark.astype(np.int8), [0]])))
        spans = tuple(map(tuple, edges.reshape(-1, 2).tolist()))
        found.append((spans, bytes(np.frombuffer(text, dtype=np.uint8)[~mark])))
    return found


def kept_of(df):
    return Counter(
        (r["doc_id"], tuple((s["start"], s["stop"]) for s in r["spans"]), bytes(r["kept"])) for r in df.collect()
    )


def expected(rows, length):
    return Counter((row[0], *kept) for row, kept in zip(rows, slow_kept([row[1] for row in rows], length), strict=True))


def naive_order(strings):
    return sorted(string[i:] for string in strings for i in range(len(string) + 1))


def test_merge_sorts_all_suffixes_and_tells_their_common_prefixes():
    generator = random.Random(7)
    for _ in range(30):
        sets = [
            [bytes(generator.choice(b"abc") for _ in range(generator.randrange(12))) for _ in range(generator.randrange(1, 5))]
            for _ in range(generator.randrange(1, 4))
        ]
        strings = [string for strings in sets for string in strings]
        text = bwt.Strings.of(strings)
        merged = bwt.merge(bwt.shards_of(text, bwt.all_suffixes(text, 1), 12, generator.choice([1, 8, 100])), 12)
        suffixes = []
        for place in merged.place.tolist():
            k = int(np.searchsorted(text.begin, place, side="right")) - 1
            suffixes.append(strings[k][place - text.begin[k] :])
        assert suffixes == naive_order(strings)
        for a, b, shared in zip(suffixes[:-1], suffixes[1:], merged.shared[1:].tolist(), strict=True):
            common = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            # Equal suffixes end together: they share all but the end, which no two have in common.
            assert shared == common


@pytest.mark.parametrize("length,step", [(1, 1), (4, 1), (6, 2), (6, 3), (12, 4), (10, 10), (20, 10), (36, 9), (40, 8)])
def test_repeats_equal_the_slow_version_for_all_shard_sizes(length, step):
    generator = random.Random(length * 100 + step)
    for _ in range(25):
        seeds = [bytes(generator.choice(b"ab") for _ in range(generator.randrange(70))) for _ in range(3)]
        strings = [
            generator.choice(seeds)[generator.randrange(10) :] + bytes(generator.choice(b"abc") for _ in range(generator.randrange(20)))
            for _ in range(generator.randrange(9))
        ]
        often = np.array([generator.random() < 0.1 for _ in strings], dtype=bool)
        shard_bytes = generator.choice([1, 50, 10_000])
        found = bwt.repeated(strings, often, length, step, shard_bytes)
        found = list(zip(*(f.tolist() for f in found), strict=True))
        assert len(set(found)) == len(found)
        assert set(found) == slow_repeats(strings, often, length)


def test_grams_of_one_hash_are_told_apart_by_their_bytes(monkeypatch):
    monkeypatch.setattr(bwt, "gram_codes", lambda text, size: np.zeros(max(len(text) - size + 1, 0), dtype=np.uint64))
    strings = [prose(1, 20).encode(), prose(2, 20).encode(), prose(1, 20).encode()[:60], b"x" * 70]
    often = np.zeros(4, dtype=bool)
    found = bwt.repeated(strings, often, 40, 20, 100)
    assert set(zip(*(f.tolist() for f in found), strict=True)) == slow_repeats(strings, often, 40)


def test_anchors_depend_on_the_window_alone():
    text = np.frombuffer((prose(3, 400) + "z" * 300 + prose(3, 400)).encode(), dtype=np.uint8)
    _, found = suffix_dedup.anchors(text, 60, 12)
    by_window = {}
    for i, anchor in enumerate(found.tolist()):
        assert by_window.setdefault(text[i : i + 60].tobytes(), anchor) == anchor
    assert len(found) == len(text) - 59


def passages():
    shared = prose(50, 60)
    rows = [(i, prose(100 + i, 80)) for i in range(12)]
    rows += [(20 + i, f"{prose(200 + i, 30)} {shared} {prose(300 + i, 30)}") for i in range(25)]
    rows += [(50 + i, near_copy(prose(60, 300), i, 3)) for i in range(6)]
    rows += [(60, shared), (61, shared), (61, shared), (62, "ab" * 300), (63, "é" * 130 + prose(100, 80)), (64, shared * 2)]
    rows += [(70, prose(70, 40) + " middle " + prose(70, 40))]
    return rows


@pytest.mark.parametrize("group_bytes", [suffix_dedup.GROUP_BYTES, 3_000, 300])
def test_repeats_are_removed_as_the_slow_version_does(spark, group_bytes):
    rows = passages()
    df = documents(spark, rows).repartition(3)
    assert kept_of(suffix_dedup.remove_repeats(df, group_bytes=group_bytes)) == expected(rows, 200)


def test_shorter_lengths_and_grams(spark):
    rows = passages()
    df = documents(spark, rows).repartition(2)
    assert kept_of(suffix_dedup.remove_repeats(df, length=63, gram=9, step=21)) == expected(rows, 63)
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(df, length=63, gram=64, step=21)
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(df, length=63, gram=9, step=20)


def test_edge_documents(spark, edge_docs, no_docs):
    got = suffix_dedup.remove_repeats(edge_docs)
    assert got.columns == ["doc_id", "n_bytes", "spans", "kept"]
    assert kept_of(got) == expected(TEXTS, 200)
    assert suffix_dedup.remove_repeats(no_docs).collect() == []


def test_long_texts_and_runs_beyond_a_piece(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE_WINDOWS", 50)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 1_000)
    rows = [(1, LONG), (2, "q" * 3_000), (3, "middle" + LONG[1_000:30_000] + "q" * 250)]
    assert kept_of(suffix_dedup.remove_repeats(documents(spark, rows))) == expected(rows, 200)


def test_a_passage_in_very_many_documents_is_parted(spark):
    shared = prose(9, 22)
    rows = [(i, f"{prose(1_000 + i, 40)} {shared} {prose(9_000 + i, 40)}") for i in range(400)]
    df = documents(spark, rows).repartition(4)
    assert kept_of(suffix_dedup.remove_repeats(df, length=100, gram=20, step=20, group_bytes=2_000)) == expected(rows, 100)


def test_clashing_columns_do_no_harm(spark):
    assert edge_documents(spark).columns[2:]
    assert suffix_dedup.remove_repeats(edge_documents(spark)).count() == len(TEXTS)


def test_tables_on_the_way_are_removed(spark):
    rows = [(n, f"{n} " + "the same passage " * 20) for n in range(4)]
    folder = shared_folder(spark)
    before = set(os.listdir(folder))
    cut = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {name.split("-")[1] for name in set(os.listdir(folder)) - before} == {"spans"}
    assert all(len(row.spans) == 1 for row in cut.collect())
