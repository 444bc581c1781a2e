"""CSV files cut into many tasks give the rows of one task per file."""

import random

import pytest
from pyspark.sql import types as T

from civicloom.sources.splitcsv import ends_inside, split_records
from civicloom.sources.tables import count_bad_records, read_complaints_csv

SCHEMA = T.StructType().add("id", "long").add("text", "string").add("note", "string")


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "8"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def field(rng):
    kind = rng.random()
    inner = "".join(rng.choice(['a', 'é', ',', '""', '\n', '\r\n', ' ', 'ไฟ']) for _ in range(rng.randint(0, 12)))
    if kind < 0.6:
        return f'"{inner}"'
    if kind < 0.7:
        return '5" pipe'  # a quote that opens nothing
    if kind < 0.75:
        return '"closed" and more"'
    return rng.choice(["", "plain", " spaced ", "x y"])


def write(path, rng, rows, end="\n", last=True, head="id,text,note"):
    lines = [head] + [f"{k},{field(rng)},{field(rng)}" for k in range(rows)]
    for _ in range(3):
        lines.insert(rng.randint(1, len(lines)), "")
    path.write_bytes((end.join(lines) + (end if last else "")).encode())


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(6))
def test_split_files_give_the_same_rows(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    folder = tmp_path / "in"
    folder.mkdir()
    for k in range(3):
        write(folder / f"{k}.csv", rng, rng.choice([0, 1, 40, 80]), rng.choice(["\n", "\r\n"]), rng.random() < 0.5)
    whole = read_complaints_csv(spark, str(folder), SCHEMA, split=False)
    cut = read_complaints_csv(spark, str(folder), SCHEMA)
    assert cut.rdd.getNumPartitions() > 3
    assert rows_of(cut) == rows_of(whole)
    assert cut.dtypes == whole.dtypes


def test_a_record_over_many_splits(spark, tmp_path, small_splits):
    rows = [(1, "x\n" * 300, "a"), (2, 'b,"' * 100, None), (3, "\n\n", "c\n" * 90)]
    lines = ["id,text,note"] + [
        ",".join(str(v) if isinstance(v, int) else "" if v is None else '"' + v.replace('"', '""') + '"' for v in row)
        for row in rows]
    (tmp_path / "a.csv").write_text("\n".join(lines))
    assert rows_of(read_complaints_csv(spark, str(tmp_path / "a.csv"), SCHEMA)) == rows_of(
        spark.createDataFrame(rows, SCHEMA))
    heads = split_records(spark, str(tmp_path / "a.csv")).where("head").collect()
    assert [r["record"] for r in heads] == ["id,text,note"]


def test_byte_order_mark_bad_records_and_other_headers(spark, tmp_path, small_splits):
    text = "note, id ,text\n" + "".join(f'n{k},{k if k % 7 else "bad"},"t\n{k}"\n' for k in range(60))
    (tmp_path / "a.csv").write_bytes(b"\xef\xbb\xbf" + text.encode())
    found = {}
    for split in (True, False):
        read = read_complaints_csv(spark, str(tmp_path / "a.csv"), SCHEMA, "bad", split=split)
        found[split] = (rows_of(read.drop("bad")), count_bad_records(read, "bad").first())
    assert found[True] == found[False] and found[True][1]["bad"] == 9
    (tmp_path / "two").mkdir()
    (tmp_path / "two" / "a.csv").write_text("id,text,note\n1,a,b\n")
    (tmp_path / "two" / "b.csv").write_text("id,note,text\n1,a,b\n")
    with pytest.raises(Exception, match="another header"):
        read_complaints_csv(spark, str(tmp_path / "two"), SCHEMA, split=True).collect()


def test_where_quotes_open():
    for line, outside, inside in [
        ("a,b", False, True), ('"a', True, False), ('"a""', True, False), ('"a"', False, False), ('5" x,"b', True, True),
        ('"a" x",b', False, False), ("", False, True), ('""', False, True), ('","', False, True), (',"', True, False),
    ]:
        assert ends_inside(line, False) == outside, line
        assert ends_inside(line, True) == inside, line
