"""Delimited text, hand-off and result tables."""

from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from closebook import schemas, session
from closebook.plans import ledger
from closebook.sources import delimited, tables


def _write(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)
    return str(folder)


def test_scan_by_name_with_decimal_comma(spark, tmp_path, rows):
    folder = _write(tmp_path / "in", "a.csv", ";I17ESTAMOUNT;I17REFOBJID;I17KEYDATE\n0;1234,5;X;20220331\n1;;Y;\n")
    schema = "I17REFOBJID string, I17KEYDATE int, I17ESTAMOUNT double"
    assert rows(delimited.read_delimited(spark, folder, schema)) == [("X", 20220331, 1234.5), ("Y", None, None)]
    with pytest.raises(ValueError, match="not in the file"):
        delimited.read_delimited(spark, folder, "other string")


def test_scan_with_comma_and_point(spark, tmp_path, rows):
    folder = _write(tmp_path / "in", "a.csv", "G/L Account,NewGL Segment,Amount\nA,S,1.5\n")
    df = delimited.read_delimited(spark, folder, "`G/L Account` string, Amount double", sep=",", decimal=".")
    assert rows(df) == [("A", 1.5)]


def test_bad_number_stops_the_job(spark, tmp_path):
    folder = _write(tmp_path / "in", "a.csv", "x\nabc\n")
    with pytest.raises(Exception, match="(?i)cast|malformed|invalid"):
        delimited.read_delimited(spark, folder, "x double").collect()


def test_write_and_read_back(spark, frame, tmp_path):
    values = [("A", 302749820.77, 1), ("B", -0.125, 2), ("C", None, None), ("D", 1200.5899999999997, 3)]
    df = frame(values, "k string, amount double, n int")
    path = str(tmp_path / "out")
    delimited.write_delimited(df, path)
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("*.csv"))
    assert "A;302749820,77;1" in text and "E" not in text
    back = delimited.read_delimited(spark, path, "k string, amount double, n int")
    assert {r.k: (r.amount, r.n) for r in back.collect()} == {k: (a, n) for k, a, n in values}


def test_headerless_extract(spark, frame, tmp_path, rows):
    fields = list(schemas.LEDGER_FIELDS)
    names = {f: f"Name {i}" for i, f in enumerate(fields)}
    names["/BA1/K5SAMBAL"] = schemas.FUNCTIONAL_AMOUNT
    names["/BA1C/BTTRAMTC"] = schemas.TRANSACTION_AMOUNT
    _write(tmp_path, "fields.csv", "Field;Name;Position\n" + "".join(f"{f};{names[f]};{i}\n" for i, f in reversed(list(enumerate(fields, 1)))) + "UNUSED;Unused;0\n")
    line = ";".join(["u", *("12.50-" if f == "/BA1/K5SAMBAL" else "3.25" if f == "/BA1C/BTTRAMTC" else "t" for f in fields)])
    folder = _write(tmp_path / "csv", "one.csv", line + "\n")
    _write(tmp_path / "csv", "two.csv", line.replace("12.50-", "1.00") + "\n")
    dictionary = delimited.read_delimited(spark, str(tmp_path / "fields.csv"), schemas.FIELD_NAMES)
    raw = delimited.read_headerless(spark, folder, delimited.field_names(dictionary))
    out = ledger.ledger_extract(raw, dictionary)
    assert len(out.columns) == 30 and "Unused" not in out.columns
    assert rows(out.select(f"`{schemas.FUNCTIONAL_AMOUNT}`", f"`{schemas.TRANSACTION_AMOUNT}`")) == [(-12.5, 3.25), (1.0, 3.25)]


def test_project_by_file(spark, tmp_path, rows):
    folder = _write(tmp_path / "in", "202201_x.csv", "a;b\n1;2\n")
    _write(tmp_path / "in", "202201_y.csv", "a;b\n3;4\n")
    _write(tmp_path / "in", "202202_z.csv", "a;b\n5;6\n")
    files = spark.read.csv(folder, sep=";", header=True)
    out = ledger.ledger_project(files, ["a"])
    assert rows(out) == [("202201", "1"), ("202201", "3"), ("202202", "5")]
    tables.write_result(out, str(tmp_path / "parts"), partition_by=["src"])
    back = tables.read_result(spark, str(tmp_path / "parts"))
    assert back.filter("src = 202201").count() == 2


def test_sample_and_hand_off(spark, rows):
    df = spark.range(1000).select((F.lit(1000) - F.col("id")).alias("k"))
    assert rows(tables.first_rows(df, 3, "k")) == [(1,), (2,), (3,)]
    held = tables.hand_off(df)
    assert held.count() == 1000
    assert "Range" not in held._jdf.queryExecution().optimizedPlan().toString()


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.fresh_path(spark, "x").startswith(named + "/x-")
    assert session.fresh_path(spark, "x") != session.fresh_path(spark, "x")


def test_cluster_without_shared_folder_is_refused():
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    cluster = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context
    )
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(cluster)


def test_dictionary_of_any_length(spark, frame):
    wide = frame([tuple(range(3))], "f1 int, f5999 int, other int")
    dictionary = frame([(f"f{i}", f"Name {i}", i) for i in range(6000)], "Field string, Name string, Position int")
    assert delimited.rename_by_dictionary(wide, dictionary).columns == ["Name 1", "Name 5999", "other"]
    assert delimited.field_names(dictionary)[5998:] == ["f5998", "f5999"]
    with pytest.raises(ValueError, match="position"):
        delimited.field_names(frame([("a", 1), ("b", 1)], "Field string, Position int"))


def test_amounts_are_written_exactly(spark, frame, tmp_path):
    values = [3e-14, 0.1 + 0.2, 1.2345678901234568e-10, 1e22, -5e-324, 1.7976931348623157e308, 12345678.9, 0.0]
    df = frame([(i, v) for i, v in enumerate([*values, float("nan"), None])], "i int, x double")
    for name, mark in (("comma", ","), ("point", ".")):
        path = str(tmp_path / name)
        delimited.write_delimited(df, path, decimal=mark)
        back = delimited.read_delimited(spark, path, "i int, x double", decimal=mark)
        assert [r.x for r in back.orderBy("i").collect()] == [*values, None, None]


def test_decimals_with_comma_and_nan_text(spark, tmp_path):
    _write(tmp_path, "d.csv", "d;x\n1234567890123456,78;NaN\n;1,5\n-0,01;\n")
    read = delimited.read_delimited(spark, str(tmp_path / "d.csv"), "d decimal(18,2), x double")
    assert [(str(r.d), r.x) for r in read.collect()] == [("1234567890123456.78", None), ("None", 1.5), ("-0.01", None)]
    assert read.agg(F.sum("x")).first()[0] == 1.5


def test_files_by_source(spark, frame, tmp_path):
    df = frame([("202201", 1), ("202202", 2)], "src string, a int")
    delimited.write_by_source(df, str(tmp_path / "by"))
    assert sorted(p.name for p in (tmp_path / "by").glob("src=*")) == ["src=202201", "src=202202"]


def test_partitioned_writes_make_few_files(spark, tmp_path):
    df = spark.range(0, 20_000, 1, 50).selectExpr("if(id % 10 = 0, 'rare', 'hot') AS src", "id AS v")
    for name, write in (
        ("result", lambda path, rows: tables.write_result(df, path, ["src"], file_rows=rows)),
        ("delimited", lambda path, rows: delimited.write_by_source(df, path, file_rows=rows)),
    ):
        write(str(tmp_path / name), 5_000_000)
        files = [f for f in (tmp_path / name).rglob("part-*")]
        assert 2 <= len(files) <= 4
        write(str(tmp_path / f"{name}-bounded"), 3000)
        hot = list((tmp_path / f"{name}-bounded" / "src=hot").glob("part-*"))
        assert 6 <= len(hot) <= 8
        assert len(list((tmp_path / f"{name}-bounded" / "src=rare").glob("part-*"))) <= 2
    back = tables.read_result(spark, str(tmp_path / "result-bounded"))
    assert back.groupBy("src").count().orderBy("src").collect() == [("hot", 18_000), ("rare", 2000)]
    assert max(r["count"] for r in back.groupBy(F.input_file_name()).count().collect()) == 3000


def test_unpartitioned_writes_are_bounded_too(spark, tmp_path):
    tables.write_result(spark.range(0, 100, 1, 1), str(tmp_path / "t"), file_rows=30)
    assert len(list((tmp_path / "t").glob("part-*"))) == 4
    delimited.write_delimited(spark.range(0, 100, 1, 1), str(tmp_path / "c"), file_rows=30)
    assert len(list((tmp_path / "c").glob("part-*"))) == 4
