"""Exact copies, similar documents and fingerprints against brute force."""

import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import combinations

import numpy as np
import pytest
from cases import CLASHING, TEXTS, documents, near_copy, prose
from pyspark.sql import functions as F

from surveysieve.llm import exact_dedup, hashing, jaccard, simhash

# Exact copies


def brute_copies(rows):
    groups = defaultdict(list)
    for place, (doc_id, text) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc_id is None, doc_id or 0, place))
    out = Counter()
    for content, members in groups.items():
        members.sort()
        keep = None if members[0][1] else members[0][2]
        for number, (_, unknown, doc_id, _) in enumerate(members):
            digest = hashlib.sha256(content.encode()).hexdigest()
            out[None if unknown else doc_id, keep, len(members), number == 0, digest] += 1
    return out


def found_copies(df):
    return Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect())


@pytest.mark.parametrize("hot_rows", [2, 500])
def test_copies(spark, edge_docs, hot_rows):
    assert found_copies(exact_dedup.mark_copies(edge_docs, hot_rows=hot_rows)) == brute_copies(TEXTS)
    rows = [(i, ["same text here", "same  text\nhere", f"own {i}", None, ""][i % 5]) for i in range(300)]
    docs = documents(spark, rows).repartition(7, "doc_id")
    assert found_copies(exact_dedup.mark_copies(docs, hot_rows=hot_rows)) == brute_copies(rows)


@pytest.mark.parametrize("hot_rows", [2, 500])
def test_texts_that_share_a_digest_are_told_apart(spark, hot_rows):
    rows = [(i, ["ab", "a b", "cd", "c d ", "e", "e ", "fgh"][i % 7] * (1 + i % 2)) for i in range(60)]

    def length_only(content):
        return F.unhex(F.lpad(F.hex(F.length(content)), 4, "0"))

    docs = documents(spark, rows).repartition(5)
    found = Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.mark_copies(docs, length_only, hot_rows).collect())
    assert found == Counter({key[:4]: n for key, n in brute_copies(rows).items()})
    kept = {r.doc_id for r in exact_dedup.drop_copies(docs, length_only, hot_rows).collect()}
    assert kept == {key[0] for key in found if key[3]}


def test_dropping_copies_keeps_columns(edge_docs, no_docs):
    kept = exact_dedup.drop_copies(edge_docs)
    assert kept.columns == edge_docs.columns == ["doc_id", "text", *CLASHING]
    expected = Counter(key[0] for key in brute_copies(TEXTS).elements() if key[3])
    rows = kept.collect()
    assert Counter(row[0] for row in rows) == expected
    texts = {text for _, text in TEXTS}
    assert all(row[1] in texts and row[2] == "extra" and row[3] is None for row in rows)
    assert exact_dedup.drop_copies(no_docs).count() == 0
    assert exact_dedup.mark_copies(no_docs).count() == 0


def test_exact_copies_use_no_python(edge_docs):
    plan = exact_dedup.mark_copies(edge_docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# Similar documents


def brute_shingles(text, size=5):
    words = re.split(r"[ \t\n\r\x0b\x0c]+", (text or "").strip(" \t\n\r\x0b\x0c"))
    words = [word for word in words if word]
    size = min(size, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if words else frozenset()


def brute_classes(rows, limit=Fraction(4, 5)):
    sets = [brute_shingles(text) for _, text in rows]
    linked = [set() for _ in rows]
    for a, b in combinations(range(len(rows)), 2):
        x, y = sets[a], sets[b]
        if x == y or (len(x & y) >= limit * len(x | y) and x and y):
            linked[a].add(b)
            linked[b].add(a)
    classes, out = {}, Counter()
    for place in range(len(rows)):
        if place not in classes:
            members, todo = set(), [place]
            while todo:
                member = todo.pop()
                if member not in members:
                    members.add(member)
                    todo += linked[member]
            ids = [rows[m][0] for m in members if rows[m][0] is not None]
            classes.update(dict.fromkeys(members, (min(ids, default=None), frozenset(members))))
    for place, (doc_id, _) in enumerate(rows):
        out[doc_id, classes[place][0], len(linked[place]), sets.count(sets[place])] += 1
    return out, {members for _, members in classes.values()}


def similar_rows():
    rows = []
    for base in range(12):
        text = prose(base, 60 + 25 * base)
        rows.append(text)
        rows += [near_copy(text, 100 * base + i, 1 + i % 4) for i in range(base)]
        rows += [text] * (base % 3)
    shared = prose(999, 80)
    rows += [shared + " " + prose(2_000 + i, 40) for i in range(30)]
    rows += ["too short", "too short", "one two three four five", "", None, " "]
    return [(i * 7 % 211, text) for i, text in enumerate(rows)]


def found_classes(df):
    return Counter((r.doc_id, r.class_id, r.n_links, r.n_copies) for r in df.collect())


@pytest.mark.parametrize("small, depth, block", [(2_000, 6, 512), (4, 2, 5), (2, 0, 3)])
def test_classes(spark, monkeypatch, small, depth, block):
    """Also with tiny limits, where nodes are split, compared block by block, and components are cut into blocks."""
    monkeypatch.setattr(jaccard, "BLOCK_SETS", block)
    rows = similar_rows()
    docs = documents(spark, rows, ["set_key"]).repartition(4)
    assert found_classes(jaccard.similarity_classes(docs, small=small, depth=depth)) == brute_classes(rows)[0]


def test_classes_of_edge_cases(edge_docs, no_docs):
    assert found_classes(jaccard.similarity_classes(edge_docs)) == brute_classes(TEXTS)[0]
    assert jaccard.similarity_classes(no_docs).count() == 0


def test_one_of_each_class_stays(spark, edge_docs, no_docs):
    for docs, rows in ((edge_docs, TEXTS), (documents(spark, similar_rows(), CLASHING), similar_rows())):
        kept = jaccard.drop_similar(docs)
        assert kept.columns == docs.columns
        expected = Counter(min((rows[m][0] for m in members if rows[m][0] is not None), default=None) for members in brute_classes(rows)[1])
        assert Counter(row[0] for row in kept.collect()) == expected
    assert jaccard.drop_similar(no_docs).count() == 0


def test_node_of_near_copies_is_compared_once():
    """Components are those of all pairs, and connected sets are not compared with each other."""
    generator = np.random.default_rng(5)
    for n, changed in ((1, 0.2), (6, 0.3), (150, 0.45), (150, 0.35), (400, 0.0)):
        centres = generator.integers(0, 256, size=(5, jaccard.TOKENS))
        sketches = centres[generator.integers(0, 5, n)]
        sketches = np.where(generator.random(sketches.shape) < changed, generator.integers(0, 256, sketches.shape), sketches).astype(np.uint8)
        sizes = generator.integers(80, 105, n).astype(np.float64)
        alike = (sketches[:, None] == sketches[None]).sum(axis=2) >= 32
        alike &= np.minimum.outer(sizes, sizes) >= 0.8 * np.maximum.outer(sizes, sizes)
        expected = list(range(n))
        for _ in range(n):
            expected = [min(expected[b] for b in np.flatnonzero(row)) for row in alike]
        assert jaccard.alike_roots(sizes, sketches, 32, 0.8).tolist() == expected


def test_near_copies_are_not_split_in_vain(spark, monkeypatch):
    """A class larger than a node is copied to blocks, not to all nodes of all splits."""
    base = prose(1, 200)
    rows = [(i, near_copy(base, i, 1)) for i in range(400)]
    distinct = jaccard._distinct(jaccard.shingle_sets(documents(spark, rows), 5)).localCheckpoint()
    sent, compared = [], jaccard._compared
    monkeypatch.setattr(jaccard, "_compared", lambda found, *rest: sent.append(found.count()) or compared(found, *rest))
    links = jaccard.candidates(distinct, 0.8, jaccard.TARGET_RECALL, small=50)
    roots = jaccard.components(links).groupBy("root").count().collect()
    assert [r["count"] for r in roots] == [distinct.count()]
    assert sum(sent) < 15 * 400 * 64


def test_shared_elements():
    generator = np.random.default_rng(3)
    for n in (2, 7, 40):
        sets = [np.unique(generator.integers(0, 300, size=generator.integers(0, 200))).astype(np.uint64) for _ in range(n)]
        common = jaccard._common(sets, width=64)
        for a, b in combinations(range(n), 2):
            assert common[a, b] == common[b, a] == len(set(sets[a].tolist()) & set(sets[b].tolist()))


def test_tokens_estimate_similarity():
    text = prose(1, 600)
    other = near_copy(text, 2, 12)
    a, b = hashing.shingles(text), hashing.shingles(other)
    exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((jaccard.tokens_of(a) == jaccard.tokens_of(b)).mean() - exact) < 0.2
    assert len(a) == len(brute_shingles(text))


def test_runs_reach_the_recall():
    for target in (0.9, 0.999999):
        tokens = [token for run in jaccard.root_tokens(0.8, target) for token in run]
        assert len(tokens) == len(set(tokens)) and 0.2 ** len(tokens) <= 1 - target
    with pytest.raises(ValueError):
        jaccard.root_tokens(0.05, 0.999999)


def test_splitting_is_counted_in_the_recall():
    generator = np.random.default_rng(21)

    def met(agrees, depth):
        return not depth or any(agrees[token] and met(agrees, depth - 1) for token in generator.integers(0, jaccard.TOKENS, jaccard.CHILDREN))

    for target, depth in ((0.99, jaccard.DEPTH), (0.95, 2)):
        tokens = [token for run in jaccard.root_tokens(0.8, target, depth=depth) for token in run]
        pairs = generator.random((20_000, jaccard.TOKENS)) < 0.8
        missed = sum(not any(agrees[token] and met(agrees, depth) for token in tokens) for agrees in pairs) / len(pairs)
        assert missed <= (1 - target) * 1.1
        assert abs(missed - jaccard.lost(0.8, len(tokens), depth)) < 0.003
    assert sum(map(len, jaccard.root_tokens(0.8, 0.999999))) >= 15
    # Where too many splits lose the pairs, fewer are made.
    assert jaccard.needed_tokens(0.5, 0.999999, jaccard.DEPTH) is None and jaccard.needed_tokens(0.5, 0.999999, 0) == 20


def test_components(spark):
    generator = np.random.default_rng(11)
    pairs = [(int(a), int(b)) for a, b in generator.integers(0, 400, size=(300, 2))] + [(1_000, 1_000 + i) for i in range(50)]
    pairs += [(2_000 + i, 2_001 + i) for i in range(40)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    found = {r.node: r.root for r in jaccard.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == {x: root(x) for x in parent}


# Fingerprints


def slow_fingerprint(text):
    """One term and one bit at a time."""
    words = [int(h) for h in hashing.word_hashes(text)]
    mask = 2**64 - 1

    def mixed(v):
        v = (v ^ (v >> 30)) * int(hashing.MIX[0]) & mask
        v = (v ^ (v >> 27)) * int(hashing.MIX[1]) & mask
        return v ^ (v >> 31)

    singles = Counter(words)
    pairs = Counter(mixed((a * 3 + b) & mask) for a, b in zip(words, words[1:]))
    votes = [0.0] * simhash.BITS
    for terms, scale in ((singles, 1), (pairs, 2)):
        for term, count in terms.items():
            for block in range(simhash.BITS // 64):
                value = mixed((term + (block + 1) * 0x9E3779B97F4A7C15) & mask).to_bytes(8, "little")
                for byte, bits in enumerate(value):
                    for bit in range(8):
                        sign = 1 if bits >> (7 - bit) & 1 else -1
                        votes[64 * block + 8 * byte + bit] += sign * scale * (1 + np.log(count))
    return np.array(votes)


def test_fingerprint_equals_a_slow_one():
    for text in ("", "one", "one two one two three", prose(3, 200, 50), TEXTS[10][1]):
        votes = slow_fingerprint(text)
        bits = np.unpackbits(simhash.fingerprint(text))
        clear = np.abs(votes) > 1e-3
        assert (bits[clear] == (votes[clear] > 0)).all()


@pytest.mark.parametrize("partitions", [1, 3, 30])
def test_edited_and_next(spark, partitions):
    rows = [(i * 5 % 101 - 20, prose(i, 1 + i % 30)) for i in range(60)] + [(None, "no id"), (None, None), (500, None), (500, "tie")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        found = simhash.compare_edited(documents(spark, rows, ["fingerprint"])).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    expected = Counter()
    for (doc_id, text), (_, following) in zip(order, order[1:] + order[:1]):
        text, following = text or "", following or ""
        cut = len(text) // 3
        changed = text[: len(text) - cut] + following[:cut]
        own, other, next_own = (simhash.fingerprint(t) for t in (text, changed, following))
        distances = [sum(bin(a ^ b).count("1") for a, b in zip(own.tolist(), x.tolist())) for x in (other, next_own)]
        digest = hashlib.sha256(changed.encode()).hexdigest()
        near = [1 - distance / simhash.BITS for distance in distances]
        expected[doc_id, len(text), digest, own.tobytes().hex(), other.tobytes().hex(), *near] += 1
    assert Counter(tuple(row) for row in found) == expected


def test_fingerprints_of_edge_cases(spark, edge_docs, no_docs):
    assert simhash.compare_edited(edge_docs).count() == len(TEXTS)
    assert simhash.compare_edited(no_docs).count() == 0
    single = simhash.compare_edited(documents(spark, [(1, "just one row here")])).collect()
    assert [(r.doc_id, r.near_next) for r in single] == [(1, 1.0)]
    hashed = {r.doc_id: r.fingerprint for r in simhash.fingerprints(edge_docs).collect()}
    assert hashed[4] == hashed[5] == hashed[9] == "0" * 64 and hashed[1] == hashed[2] == hashed[3]


@pytest.mark.parametrize("radius, key_blocks", [(3, 1), (3, 2), (0, 1)])
def test_pairs_within_the_radius(spark, radius, key_blocks):
    generator = np.random.default_rng(7)
    rows, bases = [], generator.integers(0, 256, size=(40, 8), dtype=np.uint8)
    for number in range(300):
        own = bases[number % 40].copy()
        for bit in generator.integers(0, 64, size=number % 6):
            own[bit // 8] ^= 1 << (bit % 8)
        rows.append((number, own.tobytes().hex()))
    rows += [(900, None), (901, rows[0][1])]
    pairs, members = simhash.near_pairs(spark.createDataFrame(rows, "doc_id long, fingerprint string"), radius, 64, key_blocks)
    distinct = sorted({fp for _, fp in rows if fp})
    expected = {}
    for a, b in combinations(distinct, 2):
        distance = (int(a, 16) ^ int(b, 16)).bit_count()
        if distance <= radius:
            expected[a, b] = distance
    found = pairs.collect()
    assert {(r.fingerprint_a, r.fingerprint_b): r.distance for r in found} == expected and len(found) == len(expected)
    assert members.count() == 301
    with pytest.raises(ValueError):
        simhash.near_pairs(members, 70, 64)


def test_a_shared_prefix_is_compared_in_blocks(spark):
    generator = np.random.default_rng(9)
    # Near copies that all share three quarters of their bits.
    rows = [(i, bytes(6).hex() + generator.integers(0, 256, size=2, dtype=np.uint8).tobytes().hex()) for i in range(200)]
    distinct = sorted({fp for _, fp in rows})
    expected = {(a, b) for a, b in combinations(distinct, 2) if (int(a, 16) ^ int(b, 16)).bit_count() <= 3}
    pairs, _ = simhash.near_pairs(spark.createDataFrame(rows, "doc_id long, fingerprint string"), 3, 64, group=30)
    found = pairs.collect()
    assert {(r.fingerprint_a, r.fingerprint_b) for r in found} == expected and len(found) == len(expected)


def test_texts_of_one_digest_stay_apart_without_ids(spark):
    rows = [(None, "abc"), (None, "xyz"), (None, "xyz"), (7, "a b"), (7, "b c")]
    found = exact_dedup.mark_copies(documents(spark, rows), digest=lambda content: F.lit(b"same")).collect()
    assert sorted((r.group_size, r.kept) for r in found) == [(1, True), (1, True), (1, True), (2, False), (2, True)]
