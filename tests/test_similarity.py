"""Similar texts against all pairs by dynamic programming."""

import gc
import itertools
import math
import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from surveysieve.functions.similarity_scores import (
    PLAIN_SCORERS,
    SCORERS,
    TOKEN_SET_SCORERS,
    Tokens,
    character_counts,
    lcs_lengths,
    pack,
    percent,
    score,
    sharing_score,
)
from surveysieve.operators import similarity, text_blocks, token_index
from surveysieve.operators.similarity import similar_answers, similar_pairs
from workload import queries

WORDS = "apple beta gamma delta app le bet ga mma red green blue été".split()


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before, row = row, [0]
        for k, y in enumerate(b):
            row.append(before[k] + 1 if x == y else max(before[k + 1], row[-1]))
    return row[-1]


def plain(a, b):
    total = len(a) + len(b)
    return (1 - (total - 2 * lcs(a, b)) / total) * 100 if total else 100.0


def expected_score(scorer, a, b):
    if scorer in ("ratio", "QRatio"):
        return 0 if scorer == "QRatio" and not (a and b) else plain(a, b)
    sorted_a, sorted_b = (" ".join(sorted(t.split())) for t in (a, b))
    by_order = plain(sorted_a, sorted_b)
    if scorer == "token_sort_ratio":
        return by_order
    set_a, set_b = set(a.split()), set(b.split())
    by_set = 0.0
    if set_a and set_b:
        shared, only_a, only_b = (" ".join(sorted(s)) for s in (set_a & set_b, set_a - set_b, set_b - set_a))
        with_a, with_b = (f"{shared} {only}".strip() if only else shared for only in (only_a, only_b))
        if shared and (not only_a or not only_b):
            by_set = 100.0
        else:
            head = len(shared) + 1 if shared else 0
            length = 2 * head + len(only_a) + len(only_b)
            by_set = 100 - 100 * (len(only_a) + len(only_b) - 2 * lcs(only_a, only_b)) / length
            if shared:
                by_set = max(by_set, *(100 - 100 * (len(w) - len(shared)) / (len(w) + len(shared)) for w in (with_a, with_b)))
    return by_set if scorer == "token_set_ratio" else max(by_order, by_set)


def test_pack_counts_each_partner_alone():
    rng = random.Random(3)
    texts = ["".join(rng.choices("abcé ", k=rng.randint(0, 90))) for _ in range(40)] + [""]
    partners = pack(texts)
    for text in texts:
        assert lcs_lengths(text, partners) == [lcs(text, t) for t in texts]


def test_character_counts_bound_the_score():
    rng = random.Random(4)
    texts = ["".join(rng.choices("abc dé\U0001f600", k=rng.randint(0, 30))) for _ in range(40)]
    counts = character_counts(texts)
    for (i, a), (j, b) in itertools.combinations(enumerate(texts), 2):
        shared = int(counts[[i, j]].min(axis=0).sum())
        assert shared >= lcs(a, b)
        assert percent(shared, len(a) + len(b)) >= plain(a, b)


@pytest.mark.parametrize("scorer", SCORERS)
def test_scores(scorer):
    pairs = [("red green", "green red"), ("a b c", "a b c d"), ("", ""), ("", "x"), ("a a b", "b a"), ("x y", "z w")]
    for a, b in pairs:
        form = (lambda t: t) if scorer in ("ratio", "QRatio") else (lambda t: " ".join(sorted(t.split())))
        assert score(scorer, form(a), form(b)) == pytest.approx(expected_score(scorer, a, b))


@pytest.mark.parametrize("scorer, threshold", [(s, t) for s in SCORERS for t in (65, 88.5)])
def test_similar_answers(spark, scorer, threshold):
    rng = random.Random(6)
    texts = [" ".join(rng.choices(WORDS, k=rng.randint(0, 6))) for _ in range(60)]
    texts += ["ok", "  ", "", None, "same text here", "same text here", "same text here", " same text here"]
    texts = [*texts, "ok"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, `t.x` string")
    plain_texts = [t or "" for t in texts]
    scores = {}
    for (i, a), (j, b) in itertools.combinations(enumerate(plain_texts), 2):
        if len(a.strip()) >= 7 or len(b.strip()) >= 7:
            value = int(expected_score(scorer, a, b))
            if value >= threshold:
                scores[i, j] = value
    count = dict.fromkeys(range(len(texts)), 0)
    for pair in scores:
        for i in pair:
            count[i] += 1
    found = similar_answers(df, "id", "t.x", 7, scorer, threshold, "n.n", "l.l", block_characters=200, hot_rows=2)
    got = {r["id"]: r for r in found.collect()}
    assert {i: r["n.n"] for i, r in got.items()} == {i: n for i, n in count.items() if n}
    first = {t: i for i, t in reversed(list(enumerate(plain_texts)))}
    for i, row in got.items():
        others = {}
        for j in range(len(texts)):
            pair = (min(i, j), max(i, j))
            if pair in scores and j != i:
                others.setdefault(plain_texts[j], []).append((j, scores[pair]))
        shown = []
        for text, held in others.items():
            own = text == plain_texts[i]
            name = (held[-1][0] if first[text] == i else first[text]) if own else first[text]
            times = f" x{len(held)}" if len(held) > 1 else ""
            shown.append((name, f'{name}. ({held[0][1]}) "{text}"{times}'))
        assert row["l.l"] == "; ".join(text for _, text in sorted(shown))
    pairs = similar_pairs(df, "id", "t.x", 7, scorer, threshold, block_characters=200)
    got_pairs = {(r.id_i, r.id_j): (r.score, r.copies_i, r.copies_j) for r in pairs.collect()}
    copies = {t: plain_texts.count(t) for t in plain_texts}
    expected = {}
    for (i, j), value in scores.items():
        a, b = sorted((first[plain_texts[i]], first[plain_texts[j]]))
        expected[a, b] = (value, copies[plain_texts[a]], copies[plain_texts[b]])
    assert got_pairs == expected


def lcs_of_long(a, b):
    """The same by whole rows, for long texts."""
    row, codes = np.zeros(len(b) + 1, dtype=np.int64), np.array([ord(y) for y in b])
    for x in a:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (codes == ord(x))))
    return int(row[-1])


def test_pairs_of_whole_conversations(spark, tmp_path):
    rng = random.Random(8)
    assert all(lcs_of_long(a, b) == lcs(a, b) for a, b in [("abcbdab", "bdcaba"), ("", "x"), ("été red", "tér ed")])
    # Long texts that differ only far behind their beginnings, of lengths that span classes.
    texts = []
    for length in (40, 120, 250):
        base = rng.choices(WORDS, k=length)
        texts += [" ".join(base[:-kept] + rng.choices(WORDS, k=kept)) for kept in range(1, length, length // 8)]
    texts += [" ".join(rng.choices(["xylo", "quiz", "jump", "vow"], k=200)), texts[0], texts[-1], "ok", "", None, "x" * 900]
    rows = [(i // 5, i % 5, "user", text) for i, text in enumerate(texts)]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    held = {}
    for i, text in enumerate(texts):
        held.setdefault(text or "", []).append(i // 5 * 100_000 + i % 5)
    expected = {(ids[0], ids[0]): (100, len(ids), len(ids)) for text, ids in held.items() if len(ids) > 1 and len(text) >= 7}
    for a, b in itertools.combinations(held, 2):
        sorted_a, sorted_b = (" ".join(sorted(t.split())) for t in (a, b))
        total = len(sorted_a) + len(sorted_b)
        value = 200 * lcs_of_long(sorted_a, sorted_b) // total if total else 100
        if value >= 65 and (len(a) >= 7 or len(b) >= 7):
            (first, n), (second, m) = sorted((held[t][0], len(held[t])) for t in (a, b))
            expected[first, second] = (value, n, m)
    assert len(expected) > 30
    found = queries.similar_pairs_conversations(spark, str(tmp_path)).collect()
    assert {(r.id_i, r.id_j): (r.score, r.copies_i, r.copies_j) for r in found} == expected and len(found) == len(expected)


def boxes_of(groups):
    """One row per group of texts, as a leaf."""
    rows = []
    for leaf, shapes in enumerate(groups):
        found = text_blocks.profiles(shapes)
        rows.append((leaf, len(shapes), int(found[:, 0].sum()) + len(shapes), found.min(axis=0).tolist(), found.max(axis=0).tolist()))
    return pd.DataFrame(rows, columns=["leaf", "texts", "characters", "low", "high"])


def test_blocks_of_short_texts_are_bounded():
    boxes = boxes_of([[str(100_000 + i) for i in range(5_000)]])
    plan = text_blocks.plan_meetings(boxes, 65, text_blocks.BLOCK_CHARACTERS)
    assert plan.leaves["blocks"].tolist() == [5] and plan.compared() == 5_000 * 4_999 // 2
    plan = text_blocks.plan_meetings(boxes, 65, text_blocks.BLOCK_CHARACTERS, chunk_texts=1_000)
    assert plan.leaves["chunks"].tolist() == [5] and plan.meetings["parts"].tolist() == [5]
    plan = text_blocks.plan_meetings(boxes, 65, text_blocks.BLOCK_CHARACTERS, chunk_cells=70_000_000)
    assert plan.leaves["chunks"].tolist() == [4]


def sentences(seed, n, vocabulary=400):
    """Texts of many lengths in several made-up languages, some of them near copies."""
    rng = random.Random(seed)
    letters = ["abcdefgh", "hijklmno", "nopqrstu", "stuvwxyzab"]
    words = [["".join(rng.choices(alphabet, k=rng.randint(2, 9))) for _ in range(vocabulary)] for alphabet in letters]
    texts = []
    while len(texts) < n:
        base = rng.choices(rng.choice(words), k=int(rng.lognormvariate(2.5, 0.8)) + 1)
        texts.append(" ".join(base))
        if rng.random() < 0.2:
            texts.append(" ".join([*base[:-1], rng.choice(words[0])]))
    return texts[:n]


def test_a_dropped_pair_of_leaves_holds_no_match():
    texts = sentences(5, 120)
    groups = [texts[i::15] for i in range(15)] + [[""], ["a", "b"]]
    boxes = boxes_of(groups)
    low, high = (np.array(boxes[c].tolist()) for c in ("low", "high"))
    for one, own in enumerate(groups):
        bounds = text_blocks.best_scores(low, high, one)
        for other, bound in zip(groups, bounds, strict=True):
            assert max(percent(lcs_of_long(a, b), len(a) + len(b)) for a in own for b in other) <= bound + 1e-9


def test_tree_deals_out_all_texts_and_bounds_its_leaves():
    sample = text_blocks.profiles(sentences(1, 900))
    tree = text_blocks.Tree.of(sample, 40)
    leaves = np.bincount(tree.leaf_of(sample))
    assert leaves.sum() == 900 and len(leaves) == 40 and leaves.min() > 0 and leaves.max() < 200
    assert text_blocks.Tree.of(sample[:0], 8).leaf_of(sample[:3]).tolist() == [0, 0, 0]
    alike = np.repeat(sample[:1], 50, axis=0)
    assert text_blocks.Tree.of(alike, 8).leaf_of(alike).tolist() == [0] * 50


def test_texts_that_meet_grow_slower_than_the_square():
    met = {}
    for n in (1_000, 4_000):
        shapes = sentences(2, n)
        found = text_blocks.profiles(shapes)
        tree = text_blocks.Tree.of(found, text_blocks.leaves_for(n, 90))
        leaf = tree.leaf_of(found)
        boxes = boxes_of([[shapes[i] for i in np.flatnonzero(leaf == number)] for number in range(leaf.max() + 1)])
        met[n] = text_blocks.plan_meetings(boxes, 90, text_blocks.BLOCK_CHARACTERS).compared()
    assert met[1_000] < 0.25 * 1_000**2 / 2
    assert math.log(met[4_000] / met[1_000], 4) < 1.7


@pytest.mark.parametrize("scorer", ["token_sort_ratio", "token_ratio"])
def test_pairs_do_not_depend_on_blocks_chunks_and_lanes(spark, monkeypatch, scorer):
    texts = list(dict.fromkeys([*sentences(3, 120, 60), "", " ", "ok"]))
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    found = {}
    for size in ("as usual", "tiny"):
        if size == "tiny":
            monkeypatch.setattr(text_blocks, "CHUNK_TEXTS", 3)
            monkeypatch.setattr(text_blocks, "BLOCK_TEXTS", 2)
            monkeypatch.setattr(text_blocks, "_ROWS", 2)
            monkeypatch.setattr(text_blocks.plan_meetings, "__defaults__", (3, 50_000))
            monkeypatch.setattr(token_index.candidate_pairs, "__defaults__", (2,))
        rows = similar_pairs(df, "id", "t", 3, scorer, 80, block_characters=300 if size == "tiny" else 50_000).collect()
        found[size] = {(r.id_i, r.id_j): r.score for r in rows}
        assert len(found[size]) == len(rows)
    expected = {}
    forms = texts if scorer in ("ratio", "QRatio") else [" ".join(sorted(t.split())) for t in texts]
    for i, j in itertools.combinations(range(len(texts)), 2):
        if len(texts[i].strip()) >= 3 or len(texts[j].strip()) >= 3:
            value = int(score(scorer, forms[i], forms[j]))
            if value >= 80:
                expected[i, j] = value
    assert found["as usual"] == found["tiny"] == expected and len(expected) > 10


def test_prefix_tokens_meet_every_text_that_shares_enough(spark):
    rng = random.Random(11)
    texts = [" ".join(sorted(set(rng.choices(WORDS, k=rng.randint(1, 5))))) for _ in range(80)]
    rows = [(i, text, True) for i, text in enumerate(dict.fromkeys(texts))]
    df = spark.createDataFrame(rows, "first_id long, form string, long boolean")
    for least in (40, 80, 100):
        postings = token_index.token_postings(df, least)
        pairs = {(r.id_i, r.id_j) for r in token_index.candidate_pairs(postings, 7).collect()}
        for (i, a, _), (j, b, _) in itertools.combinations(rows, 2):
            if int(sharing_score(Tokens.of(a), Tokens.of(b))) >= least:
                assert (i, j) in pairs
        assert len(pairs) < len(rows) * (len(rows) - 1) // 2


def test_token_sets_compare_far_fewer_than_all_pairs(spark):
    """Candidates of the index, on texts of frequent and rare words, from one size to four times that."""
    counts = []
    for n in (500, 2_000):
        rng = random.Random(13)
        common, rare = [f"c{i}" for i in range(30)], [f"rare{i}" for i in range(4_000)]
        texts = {" ".join(sorted({*rng.choices(common, k=8), *rng.choices(rare, k=6)})) for _ in range(n)}
        df = spark.createDataFrame([(i, t, True) for i, t in enumerate(sorted(texts))], "first_id long, form string, long boolean")
        counts.append(token_index.candidate_pairs(token_index.token_postings(df, 80)).count())
    assert counts[1] < 0.02 * 2_000**2 / 2


def test_token_set_pairs_of_whole_conversations(spark, tmp_path):
    texts = sentences(21, 90, 25) + [" ".join(["tail"] * 3 + list("abcdefg") * 4), "tail", ""]
    rows = [(i // 5, i % 5, "user", text) for i, text in enumerate(texts)]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    held = {}
    for i, text in enumerate(texts):
        held.setdefault(text, []).append(i // 5 * 100_000 + i % 5)
    expected = {(ids[0], ids[0]): 100 for text, ids in held.items() if len(ids) > 1 and len(text) >= 7}
    for a, b in itertools.combinations(held, 2):
        value = int(score("token_set_ratio", *(" ".join(sorted(t.split())) for t in (a, b))))
        if value >= 80 and (len(a) >= 7 or len(b) >= 7):
            expected[tuple(sorted((held[a][0], held[b][0])))] = value
    found = queries.similar_pairs_token_set_conversations(spark, str(tmp_path)).collect()
    assert {(r.id_i, r.id_j): r.score for r in found} == expected and len(found) == len(expected) > 10


def test_blocks_in_rounds_give_the_same_pairs(spark, monkeypatch):
    """What is copied to blocks at once stays near the size of the texts, however many blocks a text meets."""
    texts = sentences(23, 20, 4) + ["ok", "", "tail tail"]
    room = sum(map(len, texts)) // 10
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")

    def found():
        return sorted(map(tuple, similar_pairs(df, "id", "t", 3, "token_set_ratio", 70, block_characters=room).collect()))

    at_once, plan_rounds, seen = found(), text_blocks.plan_rounds, []
    monkeypatch.setattr(text_blocks, "ROUND_CHARACTERS", 1_000)
    monkeypatch.setattr(text_blocks, "plan_rounds", lambda *given: seen.append((plan_rounds(*given), *given)) or seen[-1][0])
    assert found() == at_once and len(at_once) > 5
    for rounds, plan, boxes, most in seen:
        blocks = int(plan.leaves["blocks"].sum())
        assert len(rounds) > 1 and [b for r in rounds for b in range(*r)] == list(range(blocks))
        assert most <= max(1_000, 2 * boxes["characters"].sum())


def test_candidates_get_their_texts_in_rounds(spark, monkeypatch):
    """Pairs of candidates hold both texts, so all of them at once would be very many times the texts."""
    texts = [f"same words here {i} {'abcdefgh'[i % 8]}" for i in range(22)] + ["ok", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")

    def found():
        return sorted(map(tuple, similar_pairs(df, "id", "t", 3, "token_set_ratio", 80, block_characters=50_000).collect()))

    at_once, with_texts, asked = found(), similarity.with_texts, []
    monkeypatch.setattr(text_blocks, "ROUND_CHARACTERS", 1_000)
    monkeypatch.setattr(similarity, "with_texts", lambda pairs, t: asked.append(pairs.count()) or with_texts(pairs, t))
    assert found() == at_once and len(at_once) > 30
    assert len(asked) > 3 and max(asked) < sum(asked) / 3


def test_a_list_is_written_entry_by_entry(spark, monkeypatch):
    """With 5,000 alike texts a task holds the list it writes and a batch, not the entries of many texts."""
    n = 5_000
    texts = spark.range(n).selectExpr(
        "id AS first_id", "id AS last_id", "1L AS copies", "concat('answer ', id) AS text", "cast(id AS string) AS text_key", "true AS long"
    )
    ends = spark.range(n).where("id > 0").selectExpr("0L AS id_i", "id AS id_j", "90 AS score", "1L AS copies_i", "1L AS copies_j")
    near = spark.range(n).where("id > 1").selectExpr("1L AS id_i", "id AS id_j", "80 AS score", "1L AS copies_i", "1L AS copies_j")
    lists = similarity.similar_lists(ends.unionByName(near), texts, "n", "l")
    rows = {r.first_id: r for r in lists.collect()}
    assert len(rows) == n and rows[0].n == n - 1 and rows[7].l == '0. (90) "answer 0"; 1. (80) "answer 1"'
    assert rows[0].l == "; ".join(f'{i}. (90) "answer {i}"' for i in range(1, n))

    batches = [pa.RecordBatch.from_pylist([
        {"first_id": owner, "other": k, "score": 70, "text": "t" * 50, "n": 1, "list": 0} for k in range(start, start + 100)
    ]) for owner in (1, 2) for start in range(0, 5_000, 100)]
    held = []

    def fed():
        for batch in batches:
            held.append(sum(isinstance(o, similarity._List) for o in gc.get_objects()))
            yield batch

    written = list(similarity._listed(["first_id", "n", "l", "for_copies"])(fed()))
    assert max(held) == 1 and [b.column(1).to_pylist() for b in written] == [[5_000], [5_000]]


def test_text_keys_and_limits(spark):
    df = spark.createDataFrame([("R_b", "the same answer"), ("R_a", "the same answers"), ("R_c", None)], "id string, t string")
    rows = {r.id: r.similar_list for r in similar_answers(df, "id", "t").collect()}
    assert rows == {"R_b": 'R_a. (96) "the same answers"', "R_a": 'R_b. (96) "the same answer"'}
    assert similar_pairs(df.limit(0), "id", "t").count() == 0
    for bad in ({"threshold": 0}, {"threshold": 101}, {"fuzz_func": "WRatio"}):
        with pytest.raises(ValueError):
            similar_pairs(df, "id", "t", **bad)


def test_plain_scorers_are_scorers():
    assert set(PLAIN_SCORERS) < set(SCORERS)


def test_token_scores_within_bounds_lose_nothing():

    from surveysieve.functions.similarity_scores import Tokens, token_score

    generator = random.Random(12)
    forms = [" ".join(sorted(generator.choices(["ab", "abc", "b", "cd", "acd", "dcba", "x"], k=generator.randrange(6)))) for _ in range(70)]
    for scorer in TOKEN_SET_SCORERS:
        for least in (1, 50, 80, 100):
            for a in forms:
                for b in forms:
                    exact, found = int(score(scorer, a, b)), token_score(scorer, Tokens.of(a), Tokens.of(b), least)
                    assert found == exact if exact >= least else found < least
