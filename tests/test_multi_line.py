"""CSV files with line breaks in answers, read by many tasks, against Spark's reader of whole files."""

import random

import pytest

from surveysieve.sources import multi_line, responses, sinks

SCHEMA = "id long, text string, n int, more string"


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def answers(n, seed=1):
    generator = random.Random(seed)
    pieces = ["plain", "a, b", 'said "no"', "line\nbreak", '"', "\n\n", " x ", "é", "", "tail\n", "\nhead", '""', "\r\n", ',"', '",']
    return [
        (i, "".join(generator.choices(pieces, k=generator.randrange(5))) or None, generator.choice([None, i]), generator.choice(pieces))
        for i in range(n)
    ]


def whole(spark, path, schema=SCHEMA):
    options = {**sinks.CSV_OPTIONS, "multiLine": True, "mode": "FAILFAST", "columnPruning": False}
    return spark.read.options(**options).schema(schema).csv(path)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_one_file_is_read_by_several_tasks_with_the_same_rows(spark, small_splits, tmp_path):
    path = str(tmp_path / "one")
    df = spark.createDataFrame(answers(300), SCHEMA)
    df.coalesce(1).write.options(**sinks.CSV_OPTIONS).csv(path)
    lines = spark.read.text(path, lineSep="\n")
    assert lines.rdd.getNumPartitions() > 4
    records = multi_line.read_records(spark, path, SCHEMA)
    assert rows_of(records.drop("__file", "__start", "__position")) == rows_of(whole(spark, path))
    assert records.select("__start").distinct().count() > 4
    read = responses.read_csv(spark, path, SCHEMA, key="id", multi_line=True)
    assert rows_of(read) == rows_of(whole(spark, path))


def test_several_files_and_an_answer_longer_than_splits(spark, small_splits, tmp_path):
    path = str(tmp_path / "many")
    rows = [*answers(80, 2), (1_000, "first line\n" + "long line of it\n" * 200 + "last", 5, "x"), *answers(20, 3)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.options(**sinks.CSV_OPTIONS).csv(path)
    read = responses.read_csv(spark, path, SCHEMA, key="id", multi_line=True)
    assert rows_of(read) == rows_of(whole(spark, path)) and read.count() == 101


def test_rows_are_numbered_in_file_order(spark, small_splits, tmp_path):
    path = tmp_path / "numbered.csv"
    texts = [f"answer {i}" + "\nmore" * (i % 4) for i in range(150)]
    path.write_text("q,n\r\n\r\n" + "".join(f'"{t}",{i}\r\n' + "\n" * (i % 3 == 0) for i, t in enumerate(texts)))
    read = responses.read_csv(spark, str(path), "q string, n int", multi_line=True)
    assert [(r.response_id, r.n, r.q) for r in read.orderBy("response_id").collect()] == [(i, i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("content", ["", "q,n\n", "q,n", "\n\nq,n\n\n", '"q","n"\n'])
def test_files_without_responses(spark, tmp_path, content):
    path = tmp_path / "empty.csv"
    path.write_text(content)
    assert multi_line.read_records(spark, str(path), "q string, n int").count() == 0


@pytest.mark.parametrize(
    "content",
    [
        'q,n\n"open,1\nb,2\n',
        'q,n\n5" tall,1\n6" tall,2\n',
        'q,n\na"b\nc"d,1\n',
        'q,n\n"a\nb",x\n',
        'q,n\n"a\nb"\n',
        'q,n\n"a\nb",1,2\n',
    ],
)
def test_what_does_not_fit_is_refused(spark, tmp_path, content):
    path = tmp_path / "bad.csv"
    path.write_text(content)
    with pytest.raises(Exception, match="quote|[Mm]alformed"):
        multi_line.read_records(spark, str(path), "q string, n int").collect()


def test_tables_of_splits_beyond_the_size_of_a_broadcast(spark, small_splits, tmp_path, monkeypatch):
    monkeypatch.setattr(multi_line, "is_small", lambda df: False)
    path = str(tmp_path / "sorted")
    spark.createDataFrame(answers(120, 5), SCHEMA).coalesce(1).write.options(**sinks.CSV_OPTIONS).csv(path)
    records = multi_line.read_records(spark, path, SCHEMA)
    assert rows_of(records.drop("__file", "__start", "__position")) == rows_of(whole(spark, path))
