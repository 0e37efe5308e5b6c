"""CSV folders with several headers, and quoted line breaks over the edges of byte ranges."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import types as T

from orderlens.sources import multiline, tables

PAIR = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.StringType())])


def _write(folder, **files):
    for name, text in files.items():
        (folder / f"{name}.csv").write_bytes(text.encode())
    return str(folder)


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_each_file_is_read_by_its_own_header(spark, tmp_path):
    path = _write(tmp_path, a="x,y\n1,one\n", b="y,x\ntwo,2\n", c="z,y,x\n9,three,3\n", d="", e="x,y\n")
    assert _rows(tables.read_table(spark, path, PAIR)) == Counter([(1.0, "one"), (2.0, "two"), (3.0, "three")])
    assert len(tables.headers(spark, path, multiline=False, quote_escape='"', null_value=None)) == 3
    rejected = {r.column_name: r.n_rejected for r in tables.rejected_cells(spark, path, PAIR).collect()}
    assert rejected == {"x": 0, "y": 0}
    (tmp_path / "with space.csv").write_text("y\nonly\n")
    with pytest.raises(ValueError, match="with space.csv has no column x"):
        tables.read_table(spark, path, PAIR)


def _text(rng):
    return "".join(rng.choice(['"', ",", "\n", "a", "é", " ", "\\", "b" * 9, "\n\n", '","', "x\n"]) for _ in range(rng.randint(0, 12)))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [64, 300, 1 << 20])
def test_split_reading_equals_the_whole_file_reader(spark, tmp_path, size, end):
    rng = random.Random(size)
    cell = lambda t: '"' + t.replace('"', '""') + '"' if rng.random() < 0.7 or any(c in t for c in '",\n') or t != t.strip() else t
    files = {}
    for k in range(3):
        rows = [(str(i), _text(rng)) for i in range(120)] + [("7", "long\n" * 200)]
        files[f"f{k}"] = end.join(["x,y"] + [f"{a},{cell(b)}" for a, b in rows]) + (end if k else "")
    files["g"] = f'y,x{end}"one{end if end == chr(10) else chr(10)}two",5{end}{end}last,6{end}'
    path = _write(tmp_path, **files)
    saved = spark.conf.get("spark.sql.files.maxPartitionBytes")
    whole = _rows(tables.read_table(spark, path, PAIR, multiline=True))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        got = _rows(tables.read_table(spark, path, PAIR, multiline="split"))
        ranges = multiline.open_ranges(multiline._lines(spark, [path])).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", saved)
    assert got == whole and sum(got.values()) == 3 * 121 + 2
    if size < 1000:
        assert len(ranges) > 30 and any(r.open for r in ranges)


def test_split_reading_refuses_other_escapes_and_names(spark, tmp_path):
    path = _write(tmp_path, a="x,y\n1,one\n")
    with pytest.raises(ValueError, match="doubled"):
        tables.read_text(spark, path, ["x"], multiline="split", quote_escape="\\")
    with pytest.raises(ValueError, match="split"):
        tables.read_text(spark, path, ["x"], multiline="cut")


def test_source_files_are_packed(spark, tmp_path, monkeypatch):
    from conftest import SF001
    from orderlens.plans import catalog

    monkeypatch.setattr(catalog, "scratch_path", lambda spark, name: str(tmp_path / name))
    got = catalog.csv_basetable(spark, SF001)
    files = [f for f in (tmp_path / "csv-sources").rglob("part-*")]
    assert files and all(f.name.endswith(".csv.gz") for f in files)
    assert {r.side for r in got.select("side").distinct().collect()} == {"train", "holdout"}


def test_packed_files_keep_nulls_quotes_and_column_orders(spark, tmp_path):
    rows = [(1, 'a "b", c', 40.0), (2, None, None), (3, "", -0.5), (4, "  é ", 1e-7)]
    df = spark.createDataFrame(rows, "k long, t string, v double")
    path = str(tmp_path / "packed")
    tables.write_csv(df.where("k < 3"), path, compression="gzip")
    tables.write_csv(df.where("k >= 3").select("v", "t", "k"), path, mode="append", compression="gzip")
    back = tables.read_table(spark, path, df.schema, null_value=tables.CSV_NULL)
    assert sorted(map(tuple, back.collect())) == sorted(rows)
