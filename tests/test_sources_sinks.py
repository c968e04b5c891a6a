"""CSV dialect, timestamps, discovery, JSON export and payload chunks."""

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from helpers import lines_df, pos_line
from tallyspark import schemas as S
from tallyspark.functions import parse_pos_ts, row_json
from tallyspark.sinks import bulk_payload_chunks, export_json_lines, payload_rows
from tallyspark.sources import import_counts, read_pos_drops, read_pos_lines


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def _pos_text(rows):
    header = "|".join(S.POS_COLUMNS)
    return header + "\n" + "\n".join(rows) + "\n"


def _row(**kw):
    vals = [""] * 42
    for k, v in kw.items():
        vals[S.POS_COLUMNS.index(k)] = v
    return "|".join(vals)


def test_csv_dialect(spark):
    d = tempfile.mkdtemp()
    rows = [
        _row(hd_order_or_tran_id="SALE#1", hd_store_id='""', hd_brand='"say ""hi"""', itm_sku='"a|b"'),
        _row(hd_order_or_tran_id="SALE#2"),
    ]
    _write(f"{d}/f.csv", _pos_text(rows))
    out = {r["hd_order_or_tran_id"]: r for r in read_pos_lines(spark, f"{d}/f.csv").collect()}
    assert out["SALE#1"]["hd_store_id"] == ""          # quoted empty: empty string
    assert out["SALE#2"]["hd_store_id"] is None        # empty field: NULL
    assert out["SALE#1"]["hd_brand"] == 'say "hi"'     # doubled quotes
    assert out["SALE#1"]["itm_sku"] == "a|b"           # delimiter inside quotes
    assert len(out) == 2                               # header skipped


def test_header_names_do_not_matter(spark):
    d = tempfile.mkdtemp()
    text = "|".join(f"col{i}" for i in range(42)) + "\n" + _row(hd_order_or_tran_id="X#1", country="BEL") + "\n"
    _write(f"{d}/f.csv", text)
    r = read_pos_lines(spark, f"{d}/f.csv").first()
    assert r["hd_order_or_tran_id"] == "X#1" and r["country"] == "BEL"


def test_strict_timestamp_fails_lenient_returns_null(spark):
    df = spark.createDataFrame([("2024-1-2 3:04:05",), ("2024-01-02 03:04:05",)], "t string")
    lenient = [r[0] for r in df.select(parse_pos_ts("t", strict=False)).collect()]
    assert lenient == [None, dt.datetime(2024, 1, 2, 3, 4, 5)]
    with pytest.raises(Exception):
        df.select(parse_pos_ts("t")).collect()


def test_prefix_discovery_and_counts(spark):
    d = tempfile.mkdtemp()
    _write(f"{d}/POS_20240201.csv", _pos_text([_row(hd_order_or_tran_id="A#1"), _row(hd_order_or_tran_id="A#2")]))
    _write(f"{d}/POS_20240202.csv", _pos_text([_row(hd_order_or_tran_id="B#1")]))
    _write(f"{d}/OTHER_20240201.csv", _pos_text([_row(hd_order_or_tran_id="C#1")]))
    drops = read_pos_drops(spark, d, "POS")
    assert sorted(r[0] for r in drops.select("hd_order_or_tran_id").collect()) == ["A#1", "A#2", "B#1"]
    counts = {r["drop_name"]: r["n_rows"] for r in import_counts(drops).collect()}
    assert counts == {"POS_20240201.csv": 2, "POS_20240202.csv": 1, None: 3}
    assert read_pos_drops(spark, d, "NOTHING").count() == 0


def test_row_json_keeps_nulls_and_iso_timestamps(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 2, 1, 0, 0), None)], "extract_ts timestamp_ntz, tran_id string")
    assert df.select(row_json(["extract_ts", "tran_id"])).first()[0] == \
        '{"extract_ts":"2024-02-01T00:00:00","tran_id":null}'


def test_json_export_counts_and_names(spark):
    df = lines_df(spark, [pos_line(hd_order_or_tran_id=f"SALE#{i}") for i in range(5)]).select(
        "hd_order_or_tran_id", "hd_brand")
    out = tempfile.mkdtemp()
    path, n = export_json_lines(df, out, "missed.json", dt.datetime(2024, 3, 1, 7, 5))
    assert n == 5 and path.endswith("20240301_0705_missed.json")
    lines = [json.loads(r[0]) for r in spark.read.text(path).collect()]
    assert len(lines) == 5 and all("hd_brand" in x and x["hd_brand"] is None for x in lines)


def test_payload_chunks_are_bounded_and_complete(spark):
    df = spark.range(2500).repartition(7).select(F.col("id").cast("string").alias("k"))
    chunks = bulk_payload_chunks(df, max_rows=1000)
    sizes = sorted(r["n_rows"] for r in chunks.collect())
    assert sizes == [500, 1000, 1000]
    keys = sorted(int(json.loads(r[0])["k"]) for r in payload_rows(chunks).collect())
    assert keys == list(range(2500))
    for r in chunks.collect():
        assert len(json.loads(r["payload"])) == r["n_rows"]


def test_lenient_parse_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([("2024-03-10 02:30:00",), ("bad",)], "t string")   # inside the DST gap
        got = [r[0] for r in df.select(parse_pos_ts("t", strict=False)).collect()]
        assert got == [dt.datetime(2024, 3, 10, 2, 30), None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_drop_names_of_escaped_paths(spark):
    d = tempfile.mkdtemp() + "/in drops+[1]"
    _write(f"{d}/POS A+B_1.csv", _pos_text([_row(hd_order_or_tran_id="SALE#1")]))
    _write(f"{d}/POS A+B_2.csv", _pos_text([_row(hd_order_or_tran_id="SALE#2"), _row(hd_order_or_tran_id="SALE#3")]))
    _write(f"{d}/OTHER.csv", _pos_text([_row(hd_order_or_tran_id="SALE#4")]))
    counts = {r["drop_name"]: r["n_rows"] for r in import_counts(read_pos_drops(spark, d, "POS A+B")).collect()}
    assert counts == {"POS A+B_1.csv": 1, "POS A+B_2.csv": 2, None: 3}


def test_quoted_line_breaks(spark):
    d = tempfile.mkdtemp()
    _write(f"{d}/f.csv", _pos_text([_row(hd_order_or_tran_id="SALE#1", hd_brand='"two\nlines"'), _row(hd_order_or_tran_id="SALE#2")]))
    rows = {r["hd_order_or_tran_id"]: r["hd_brand"] for r in read_pos_lines(spark, f"{d}/f.csv", multi_line=True).collect()}
    assert rows == {"SALE#1": "two\nlines", "SALE#2": None}
    with pytest.raises(Exception):  # the splitting reader refuses such a file
        read_pos_lines(spark, f"{d}/f.csv").collect()
