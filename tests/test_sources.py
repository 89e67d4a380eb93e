"""Readers, against Python's own."""

import csv
import io
import random

import pytest

from rostra.sources import records, tables


def table(seed, rows, encoding):
    rng = random.Random(seed)
    pieces = ['a', 'bc d', ',', '"', '""', '\n', '\r\n', '",', '\n"', ' ', 'é', '' if encoding == "utf-8" else 'ÿ', '東京' if encoding == "utf-8" else '¶']
    return [[str(i), "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))), rng.choice(["", "x", "two words", 'q"q'])] for i in range(rows)]


def written(rows, header, encoding, end="\n", last=True):
    out = io.StringIO(newline="")
    w = csv.writer(out, lineterminator=end)
    w.writerows([header, *rows])
    text = out.getvalue()
    return (text if last else text.removesuffix(end)).encode(encoding)


@pytest.mark.parametrize("size", ["57b", "200b", "128m"])
def test_records_cross_range_borders(spark, tmp_path, size):
    files = {"a.csv": (table(1, 300, "utf-8"), "utf-8", "\n", True), "b.csv": (table(2, 200, "latin-1"), "latin-1", "\r\n", True),
             "c.csv": (table(3, 1, "utf-8"), "utf-8", "\n", False), "d.csv": ([], "utf-8", "\n", True),
             "e.csv": ([["0", "one field\n" * 100 + '""\n,"', "x"], ["1", "after", ""]], "utf-8", "\n", False)}
    want = []
    for name, (rows, encoding, end, last) in files.items():
        (tmp_path / name).write_bytes(written(rows, ["id", "long,\ntext", "kind"], encoding, end, last))
        want += [(r[0], r[1], r[2]) for r in rows]
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        df = tables.read_csv(spark, str(tmp_path))
        assert df.columns == ["id", "long,\ntext", "kind"]
        got = [(r[0], r[1] or "", r[2] or "") for r in df.collect()]
        tasks = df.rdd.getNumPartitions()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(got) == sorted(want)
    assert tasks > 50 if size == "57b" else tasks > 3
    typed = tables.read_csv(spark, str(tmp_path), "id int, text string, kind string").collect()
    assert sorted(r.id for r in typed) == sorted(int(w[0]) for w in want)


def test_quotes_inside_plain_fields(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿id,text\n\n1,5" tape\n2,"a ""b"" c"\n3,x"y"z\n4,"two\nlines, with ""quotes"""\n5, "no quote\n', encoding="utf-8")
    got = tables.read_csv(spark, str(tmp_path)).collect()
    assert [(r.id, r.text) for r in sorted(got)] == [("1", '5" tape'), ("2", 'a "b" c'), ("3", 'x"y"z'), ("4", 'two\nlines, with "quotes"'), ("5", ' "no quote')]


@pytest.mark.parametrize("line, closed, opened", [
    (b"a,b", False, True), (b'a,"b', True, False), (b'"', True, False), (b'""', False, True), (b'"a""', True, False),
    (b'x"y', False, False), (b'a","b', True, True), (b'"a",b,"c', True, True), (b"", False, True)])
def test_state_after_a_line(line, closed, opened):
    assert (records.ends_open(line, False), records.ends_open(line, True)) == (closed, opened)


def test_headers_with_commas(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"Job, Description",Resume Text,Match\n"x","y",1\n')
    assert tables.csv_headers(spark, str(tmp_path)).first().columns == ["job_description", "resume_text", "match"]
    with pytest.raises(FileNotFoundError):
        (tmp_path / "none").mkdir()
        tables.read_csv(spark, str(tmp_path / "none"))


def test_small_documents_are_read_many_to_a_task(spark, tmp_path):
    """a few small files filled a task, so their number of tasks grew with every document."""
    for i in range(300):
        (tmp_path / f"d{i}.txt").write_text(f"text {i}")
    (tmp_path / "README.txt").write_text("no")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
        read = tables.read_documents(spark, str(tmp_path))
        parts, texts = read.rdd.getNumPartitions(), sorted(r.text for r in read.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert parts <= 8 * spark.sparkContext.defaultParallelism and texts == sorted(f"text {i}" for i in range(300))
