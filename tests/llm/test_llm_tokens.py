"""Packing, encoding, token files and token counts against the libraries, id by id."""

import os
import uuid
import zlib
from array import array
from collections import Counter, defaultdict
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from cases import TEXTS, documents, prose
from tokenizers import Tokenizer

from surveysieve.llm import bpe, common, packing, parts, queries, token_counts, token_files, tokenizer

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

ODD = ["".join(("ab'sé1! \n\t\xa0<|\x1c　Σς.,")[(i * 7 + j * j * (i + 3)) % 19] for j in range(i % 37)) for i in range(600)]


def library_ids(path, texts):
    encodings = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    return [array("I", encoding.ids).tobytes() for encoding in encodings]


def plain_texts():
    return [text or "" for _, text in TEXTS]


@pytest.mark.parametrize("encode, path", [(tokenizer.spaced_ids, BYTES), (tokenizer.word_ids, WORDS), (bpe.encode_texts, BYTES)])
def test_ids_equal_the_librarys(encode, path):
    texts = plain_texts() + ODD + [" ".join(ODD[:300])]
    assert encode(path, texts) == library_ids(path, texts)
    assert encode(path, texts[::-1]) == library_ids(path, texts[::-1])


def test_words_of_letters_are_encoded_as_the_library_does():
    letters = [chr(code) for code in range(0x41, 0x250)] + ["\u1e00", "\u03a9", "\u2160"]
    texts = [" ".join(f"{a}{b}ab" for b in letters[i::40]) for i, a in enumerate(letters)]
    assert tokenizer.LibraryEncoder(BYTES, b"").byte_words
    assert tokenizer.spaced_ids(BYTES, texts) == library_ids(BYTES, texts)


def test_words_of_small_letters_are_encoded_as_the_library_does():
    letters = [chr(code) for code in range(0x41, 0x180)] + ["\u0301", "\u0308", "\u03a3", "\u1e9e", "\ufb01", "'s", "'re"]
    texts = [" ".join(f"{a}{b}ab a{b}{a}" for b in letters[i::30]) for i, a in enumerate(letters)]
    assert tokenizer.LibraryEncoder(WORDS, b" ").lower_words
    assert tokenizer.word_ids(WORDS, texts) == library_ids(WORDS, texts)


def test_words_stay_with_the_library_where_it_cuts_or_changes_them_otherwise(tmp_path):
    import json

    with open(WORDS, encoding="utf-8") as file:
        model = json.load(file)
    steps = model["normalizer"]["normalizers"]
    model["normalizer"]["normalizers"] = [{"type": "NFD"}, *steps[1:]]
    path = str(tmp_path / "other.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump(model, file)
    texts = ["façade été über straße", "plain words été"]
    assert not tokenizer.LibraryEncoder(path, b" ").lower_words
    assert library_ids(path, texts) != library_ids(WORDS, texts)
    assert tokenizer.word_ids(path, texts) == library_ids(path, texts)


def test_words_of_earlier_tasks_are_kept(spark):
    """Packing must not encode the words of all texts anew in each task."""

    def run(batches):
        for batch in batches:
            numbers = batch.column(0).to_pylist()
            ids = tokenizer.word_ids(WORDS, ["".join("abcdefghij"[int(digit)] for digit in f"{n:04}") for n in numbers])
            kept = len(common.on_process(("words", WORDS), dict)._kept)
            yield pa.RecordBatch.from_pydict({"worker": [os.getpid()] * len(ids), "kept": [kept] * len(ids)})

    rows = spark.range(0, 64, 1, 64).mapInArrow(run, "worker long, kept long").collect()
    tasks = Counter(row.worker for row in rows)
    # Workers may have kept words of other tests.
    assert len(tasks) < len(rows)
    assert all(max(row.kept for row in rows if row.worker == worker) >= n for worker, n in tasks.items())


def test_parts_of_one_hash_are_told_apart(monkeypatch):
    hashes = parts.hashes
    monkeypatch.setattr(parts, "hashes", lambda *given: (hashes(*given)[0] % np.uint64(2), hashes(*given)[1]))
    texts = ["one two three one", "four two five", "", "six one"]
    encoder = parts.PartEncoder(tokenizer.LibraryEncoder(BYTES, b""))
    assert encoder([text.encode() for text in texts]) == library_ids(BYTES, texts)


def test_encoded_parts_outlast_a_task(spark):
    """The package travels with each task; what its encoder keeps must not be made anew by each."""

    def run(batches):
        for batch in batches:
            made = common.on_process(("test",), lambda: uuid.uuid4().hex)
            yield pa.RecordBatch.from_pydict({"worker": [os.getpid()] * batch.num_rows, "made": [made] * batch.num_rows})

    rows = spark.range(0, 64, 1, 64).mapInArrow(run, "worker long, made string").collect()
    workers = {row.worker for row in rows}
    assert len(workers) < len(rows) and len({(row.worker, row.made) for row in rows}) == len(workers)


def test_parts_are_forgotten_without_harm():
    model = bpe.PairIndexEncoder(BYTES)
    encoder = parts.PartEncoder(lambda new: model.parts([part.decode() for part in new]), limit=5)
    texts = ["one two three", "four five six seven eight nine ten eleven", "one two three", ""]
    for chosen in (texts, texts[:1], texts[1:], texts, []):
        assert encoder([text.encode() for text in chosen]) == library_ids(BYTES, chosen)


def test_long_parts_are_told_apart():
    base = "x" * 200
    texts = [base, base + "y", "z" + base, base, "ab " + base + " " + base + "y", "x" * 64, "x" * 65, "x" * 8, "x" * 9]
    assert tokenizer.spaced_ids(BYTES, texts) == library_ids(BYTES, texts)
    assert tokenizer.word_ids(WORDS, texts) == library_ids(WORDS, texts)


def test_hashes_depend_on_every_byte():
    words = [bytes(word) for word in np.random.default_rng(1).integers(97, 123, size=(500, 20), dtype=np.uint8)]
    words += [word[:n] for word in words[:50] for n in range(1, 20)] + [b"a\x00", b"a", b"a\x00\x00"]
    distinct = sorted(set(words))
    data = np.frombuffer(b"".join(distinct), dtype=np.uint8)
    ends = np.cumsum([len(word) for word in distinct])
    starts = ends - [len(word) for word in distinct]
    for own in parts.hashes(data, starts, ends):
        assert len(set(own.tolist())) == len(distinct)


def test_decode_equals_the_librarys():
    texts = plain_texts() + ODD
    ids = library_ids(BYTES, texts)
    model = bpe.PairIndexEncoder(BYTES)
    rows = [memoryview(i).cast("I").tolist() for i in ids] + [[i] for i in range(0, 50257, 97)]
    library = Tokenizer.from_file(BYTES)
    assert [model.decode(array("I", row).tobytes()) for row in rows] == [library.decode(row, skip_special_tokens=False) for row in rows]


def test_vocabulary_with_merges_out_of_order_is_refused(tmp_path):
    import json

    with open(BYTES, encoding="utf-8") as file:
        model = json.load(file)
    model["model"]["merges"].reverse()
    path = tmp_path / "reversed.json"
    path.write_text(json.dumps(model), encoding="utf-8")
    with pytest.raises(ValueError, match="merge"):
        bpe.PairIndexEncoder(str(path))


def test_bpe_rows(spark, edge_docs, no_docs):
    rows = bpe.encode(edge_docs, BYTES, decoded=True).collect()
    expected = Counter(zip([i for i, _ in TEXTS], library_ids(BYTES, plain_texts()), plain_texts()))
    assert Counter((row.doc_id, bytes(row.ids), row.decoded) for row in rows) == expected
    assert bpe.encode(no_docs, BYTES).count() == 0
    encoded = spark.createDataFrame([(1, bytearray(b"")), (2, None)], "doc_id long, ids binary")
    assert {row.doc_id: row.text for row in bpe.decode(encoded, BYTES).collect()} == {1: "", 2: None}
    again = bpe.decode(bpe.encode(edge_docs, BYTES), BYTES)
    assert Counter((r.doc_id, r.text) for r in again.collect()) == Counter((i, t or "") for i, t in TEXTS)


# Packing


def check_pieces(rows, docs, width):
    """Every id of every document lies in exactly one piece, and sequences have no gaps and no padding."""
    wanted = Counter((doc_id, ids + b"\x01\x00\x00\x00") for doc_id, ids in docs)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for row in rows:
        assert len(row.ids) == 4 * row.length and row.length > 0
        pieces[row.doc_id, row.doc_tokens].append((row.start, bytes(row.ids)))
        sequences[row.sequence_id].append((row.offset, row.length, row.sequence_length))
    for parts in sequences.values():
        parts.sort()
        ends = list(accumulate(length for _, length, _ in parts))
        assert [offset for offset, _, _ in parts] == [0, *ends[:-1]]
        assert {total for _, _, total in parts} == {ends[-1]}
        assert ends[-1] <= width and ends[-1] & (ends[-1] - 1) == 0
    by_document = Counter()
    for (doc_id, total), parts in pieces.items():
        parts.sort()
        repeats = sum(start == 0 for start, _ in parts)
        assert sum(len(ids) for _, ids in parts) == 4 * total * repeats
        if repeats == 1:
            assert [start for start, _ in parts] == [0, *list(accumulate(len(ids) // 4 for _, ids in parts))[:-1]]
            by_document[doc_id, b"".join(ids for _, ids in parts)] += 1
        else:
            by_document.update({(doc_id, ids): n for (doc_id, ids), n in wanted.items() if len(ids) == 4 * total})
    assert by_document == wanted


@pytest.mark.parametrize("width", [1, 16, 2048])
def test_packing(edge_docs, no_docs, width):
    docs = list(zip([i for i, _ in TEXTS], library_ids(WORDS, plain_texts())))
    distinct = edge_docs.dropDuplicates(["doc_id", "text"])
    seen = list(dict.fromkeys(docs))
    check_pieces(packing.pack(distinct, WORDS, width).collect(), seen, width)
    assert packing.pack(no_docs, WORDS).count() == 0
    total = sum(row.length for row in packing.pack(edge_docs, WORDS, width).select("length").collect())
    assert total == sum(len(ids) // 4 + 1 for _, ids in docs)


def test_packing_refuses_other_widths(edge_docs):
    with pytest.raises(ValueError):
        packing.pack(edge_docs, WORDS, 1000)


def test_level_minimises_the_sum_of_squares():
    generator = np.random.default_rng(5)
    packer = packing.SquaresPacker(32)
    for number in range(3_000):
        size = int(generator.integers(1, 32))

        def squares(level, size=size):
            counts = packer.counts.copy()
            if level:
                counts[level] -= 1
            if level + size < 32:
                counts[level + size] += 1
            return int((counts[1:32] ** 2).sum())

        usable = [0, *(level for level in range(1, 33 - size) if packer.counts[level])]
        best = min(map(squares, usable))
        assert packer.level_for(size) == max(level for level in usable if squares(level) == best)
        packer.add((number, 0, bytes(4 * size), size))
        assert packer.counts[1:32].sum() == packer.n_open


def test_open_windows_stay_bounded(monkeypatch):
    monkeypatch.setattr(packing, "OPEN_WINDOWS", 10)
    packer, windows = packing.SquaresPacker(64), []
    for number in range(1_000):
        windows += packer.add((number, 0, number.to_bytes(4, "little") * 33, 33))
        assert packer.n_open <= 11
    windows += packer.finish()
    assert sum(map(packing._ids, windows)) == 33_000
    assert all(packing._ids(w) == 64 for w in windows[:-10])


def test_packing_cuts_little():
    texts = [prose(i, 50 + (i * 37) % 900) for i in range(400)]
    packer, windows, whole = packing.SquaresPacker(2048), [], 0
    for number, ids in enumerate(tokenizer.word_ids(WORDS, texts)):
        total = len(ids) // 4
        whole += -(-total // 2048)
        for start in range(0, total, 2048):
            windows += packer.add((number, start, ids[4 * start : 4 * (start + 2048)], total))
    windows += packer.finish()
    assert sum(map(len, windows)) <= 1.4 * whole
    assert sum(packing._ids(w) == 2048 for w in windows) >= len(windows) - 11


# Token files


def test_token_files(edge_docs, no_docs):
    rows = token_files.write_and_read(edge_docs, BYTES, width=64).collect()
    end = b"\x02\x00\x00\x00"
    docs = sorted(
        ((i is not None, i or 0, t), ids + end) for (i, t), ids in zip(((i, t or "") for i, t in TEXTS), library_ids(BYTES, plain_texts()))
    )
    expected, start = [], 0
    for (known, doc_id, _), ids in docs:
        expected.append((doc_id if known else None, start, len(ids) // 4, ids))
        start += len(ids) // 4
    found = sorted(((r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in rows), key=lambda r: r[1])
    assert found == expected
    assert token_files.write_and_read(no_docs, BYTES).count() == 0


def test_files_are_read_in_place(tmp_path):
    writer = token_files.TokenWriter(str(tmp_path), "some", 8, pa.uint16())
    ids = [np.arange(n, dtype=np.uint32) + 10 * n for n in (0, 1, 7, 8, 9, 5_000, 3)]
    for number, own in enumerate(ids):
        writer.add(number, own)
    writer.close()
    flat = np.concatenate(ids)
    tokens = token_files.TokenFile(str(tmp_path), "some")
    for start, n in ((0, 1), (2040, 20), (5, 4_000), (len(flat) - 1, 1), (3, 0)):
        assert tokens.ids(start, n).tolist() == flat[start : start + n].tolist()
    last = -(-len(flat) // 8) - 1
    for number in (0, 1, 255, 256, 300, last):
        own, mask = tokens.sequence(number)
        part = flat[8 * number : 8 * (number + 1)]
        assert own[mask].tolist() == part.tolist() and len(own) == len(mask) == 8
        assert not own.flags.owndata
    assert tokens.sequence(last)[1].sum() == len(flat) - 8 * last
    found = pa.Table.from_batches(list(tokens.documents()))
    assert found["n_tokens"].to_pylist() == [len(own) for own in ids]
    with pytest.raises(ValueError):
        tokens.ids(len(flat) + 10, 5)
    assert token_files.ids_type(65_535) == pa.uint16() and token_files.ids_type(65_536) == pa.uint32()


# Token counts


def brute_counts(text, rule):
    """Each token's bytes are looked at one by one."""
    import base64

    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    encoding = tiktoken.Encoding("own", pat_str=bpe.WORDS, mergeable_ranks=ranks, special_tokens={})
    owners, section = [], 0
    for byte in text.encode():
        owners.append(section)
        section += byte == 10
    counts, place = Counter(), 0
    tokens = [encoding.decode_single_token_bytes(i) for i in encoding.encode_ordinary(text)]
    for token in tokens:
        own = owners[place : place + len(token)]
        place += len(token)
        owner = own[0] if rule == "first" else own[-1] if rule == "last" else max(dict.fromkeys(own), key=own.count)
        counts[owner] += 1
    n = max(1, section + (bool(text) and not text.endswith("\n")))
    return [counts[i] for i in range(n)], len(tokens)


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_sections(spark, no_docs, rule):
    texts = [*TEXTS, (20, "a\n\n\n\nb\n \n c"), (21, "\n"), (22, "\n\n"), (23, "x = 1;\n\n    y"), (24, "end\n")]
    rows = token_counts.count_sections(documents(spark, texts, ["section", "Text"]), RANKS, rule).collect()
    found = defaultdict(list)
    for row in sorted(rows, key=lambda r: (r.doc_id or 0, r.section)):
        found[row.doc_id].append((row.start, row.length, row.n_tokens, row.doc_tokens))
    once = {i: t or "" for i, t in texts if i not in (2, None)}
    for doc_id, text in once.items():
        counts, total = brute_counts(text, rule)
        lines = found[doc_id]
        assert [n for _, _, n, _ in lines] == counts
        assert {t for *_, t in lines} == {total}
        assert "".join(text[start : start + length] for start, length, _, _ in lines) == text
    assert len(found[2]) == 2 * len(found[1])
    assert token_counts.count_sections(no_docs, RANKS).count() == 0


def test_fields(spark):
    rows = [(1, "one two", "three", None), (2, None, None, None), (None, "", "x\ny", "é")]
    df = spark.createDataFrame(rows, "id long, a string, b string, tokens_a string")
    found = {r.id: (r.tokens_a, r.tokens_b, r.tokens_tokens_a) for r in token_counts.count_fields(df, "id", ["a", "b", "tokens_a"], RANKS).collect()}
    encoder = token_counts.OffsetEncoder(RANKS)
    for key, *fields in rows:
        whole = "\n".join(field or "" for field in fields)
        assert sum(found[key]) == len(encoder.ends(whole))
    assert found[1][:2] == (3, 2) and found[1][2] == 0


def test_rules_are_checked(edge_docs):
    with pytest.raises(ValueError):
        token_counts.count_sections(edge_docs, RANKS, "middle")


def test_queries_give_checksums(spark):
    sf_dir = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    texts = [row.text or "" for row in documents]
    ids = [i + b"\x02\x00\x00\x00" for i in library_ids(BYTES, texts)]
    starts = [0, *accumulate(len(i) // 4 for i in ids)]
    rows = sorted(queries.QUERIES["op7_token_files"](spark, sf_dir).collect(), key=lambda r: r.doc_id)
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows] == [
        (d.doc_id, s, len(i) // 4, zlib.crc32(i)) for d, s, i in zip(documents, starts, ids)
    ]
    whole = {d.doc_id: i + b"\x01\x00\x00\x00" for d, i in zip(documents, library_ids(WORDS, texts))}
    for row in queries.QUERIES["op1_packing"](spark, sf_dir).collect():
        own = whole[row.doc_id]
        assert row.doc_tokens == len(own) // 4
        assert row.ids_crc32 == zlib.crc32(own[4 * row.start : 4 * (row.start + row.length)])
