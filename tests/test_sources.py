"""Sources and sinks: typed CSV scan with header contract, model table round trip, build write."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from shoplens.functions.text import py_strip
from shoplens.operators.scoring import score
from shoplens.plans.build import Build
from shoplens.sources import sinks
from shoplens.sources.csv_source import read_source_csv

from .conftest import SF_SMALL

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"


def _csv(text: str) -> str:
    d = tempfile.mkdtemp(prefix="shoplens-csv-", dir="/tmp")
    path = os.path.join(d, "lines.csv")
    with open(path, "w") as fh:
        fh.write(text)
    return path


def test_typed_scan_with_tokens_and_formats(spark):
    path = _csv(
        HEADER
        + "536365, 85123a ,WHITE HANGING,6,12/1/2010 8:26,2.55,17850,United Kingdom\n"
        + "C536379,D,Discount,-1,2010-12-01 09:41:00,27.5,NA,United Kingdom\n"
        + "536366,22633,HAND WARMER,6,2010-12-01T08:28:00,,17850,NULL\n"
    )
    df = read_source_csv(spark, path).collect()
    assert [r.quantity for r in df] == [6, -1, 6]
    assert df[1].customer_id is None and df[2].country is None and df[2].unit_price is None
    assert df[0].invoice_date.hour == 8 and df[2].invoice_date.minute == 28


def test_quotes_line_breaks_and_local_times(spark):
    path = _csv(
        HEADER
        + '1,22633,"SET ""A"", BIG",6,3/13/2011 2:30,2.55,17850,United Kingdom\n'
        + '2,22633,"TWO\nLINES",6,2011-03-13 02:30:00,2.55,17850,United Kingdom\n'
    )
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        rows = read_source_csv(spark, path, multi_line=True).orderBy("invoice_no").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [r.description for r in rows] == ['SET "A", BIG', "TWO\nLINES"]
    assert [(r.invoice_date.hour, r.invoice_date.minute) for r in rows] == [(2, 30), (2, 30)]


def test_unreadable_dates_fail(spark):
    for text in ("13/45/2011 8:26", "soon"):
        with pytest.raises(Exception):
            read_source_csv(spark, _csv(HEADER + f"1,22633,X,1,{text},1.0,1,UK\n")).collect()


def test_strip_takes_every_kind_of_space(spark):
    texts = ["\u00a0a\u3000", "\x1c b\x85", "\u2003", "a\u00a0b"]
    got = [r.t for r in spark.createDataFrame([(t,) for t in texts], "t string").select(py_strip(F.col("t")).alias("t")).collect()]
    assert got == [t.strip() for t in texts]


def test_build_from_csv_keeps_two_spellings_of_a_date_apart(spark):
    line = "{},10000,TEST PRODUCT,{},{},10.0,{},United Kingdom\n"
    path = _csv(
        HEADER
        + line.format("100", 10, "1/1/2011 0:00", "A") * 3
        + line.format("100", 10, "2011-01-01", "A")
        + line.format("C100", -2, "1/2/2011 0:00", "A")
        + line.format("101", 1, "2/1/2011 0:00", "\u00a0")
        + line.format("102", 1, "2/1/2011 0:00", "B")
    )
    b = Build.from_csv(spark, path)
    rfm = {r.customer_id: r for r in b.rfm.collect()}
    assert set(rfm) == {"A", "B"}
    assert (rfm["A"].frequency, float(rfm["A"].gross_monetary), float(rfm["A"].net_monetary)) == (1, 200.0, 180.0)
    assert b.dedup.agg(F.sum("copies")).first()[0] == 7 and b.dedup.count() == 5


def test_wrong_header_fails(spark):
    path = _csv("Invoice,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n1,2,3,4,2010-12-01,1,2,3\n")
    with pytest.raises(Exception):
        read_source_csv(spark, path).collect()


def test_bad_quantity_fails(spark):
    path = _csv(HEADER + "1,22633,X,six,2010-12-01,1.0,1,UK\n")
    with pytest.raises(Exception):
        read_source_csv(spark, path).collect()


def test_model_table_round_trip_scores_like_the_model(spark):
    b = Build.of(spark, SF_SMALL)
    out = tempfile.mkdtemp(prefix="shoplens-model-", dir="/tmp")
    path = sinks.write_model_params(b, out)
    params = sinks.read_model_params(spark, path)
    scored = {r.customer_id: r.segment_code for r in score(b.rfm, params).select("customer_id", "segment_code").collect()}
    stored = {r.customer_id: r.segment_code for r in b.segmented.select("customer_id", "segment_code").collect()}
    assert scored == stored


def test_write_build_and_schema_gate(spark):
    b = Build.of(spark, SF_SMALL)
    out = tempfile.mkdtemp(prefix="shoplens-build-", dir="/tmp")
    manifest = sinks.write_build(b, out)
    assert manifest["counts"]["segment_profiles"] == 4
    meta = spark.read.parquet(manifest["tables"]["model_metadata"])
    sinks.assert_schema_version(meta)
    bad = meta.withColumn("metadata_value", F.when(F.col("metadata_key") == "schema_version", "99").otherwise(F.col("metadata_value")))
    with pytest.raises(ValueError):
        sinks.assert_schema_version(bad)


def test_json_export_keeps_nulls(spark):
    from shoplens.plans import catalog_model

    out = tempfile.mkdtemp(prefix="shoplens-json-", dir="/tmp")
    paths = sinks.export_sections({"kpp_weights": catalog_model.kpp_weights(spark, SF_SMALL)}, out)
    back = spark.read.json(paths["kpp_weights"])
    first = back.where("center_number = 1").select("probability").first()
    assert "probability" in back.columns and first.probability is None


def _folder(files: dict[str, str]) -> str:
    d = tempfile.mkdtemp(prefix="shoplens-csv-", dir="/tmp")
    for name, text in files.items():
        with open(os.path.join(d, name), "w") as fh:
            fh.write(text)
    return d


def test_rows_are_numbered_in_file_order_and_the_first_copy_stays(spark):
    """Several files and many splits of one file: numbers 2..n+1 along the files, whatever the splits and partitions."""
    rng = random.Random(2)
    lines = [f"{rng.randint(1, 60)},{rng.randint(10000, 10009)},D{rng.randint(1, 3)},{rng.randint(1, 3)},2011-03-0{rng.randint(1, 9)} 10:00:00,1.5,{rng.choice(['7', '8', ''])},UK\n"
             for _ in range(900)]
    cuts = [0, 5, 400, 400, 900]
    path = _folder({f"part-{n}.csv": HEADER + "".join(lines[a:b]) for n, (a, b) in enumerate(zip(cuts, cuts[1:]))})
    first, copies = {}, {}
    for n, line in enumerate(lines):
        first.setdefault(line, n + 2)
        copies[line] = copies.get(line, 0) + 1
    known = {line: i + 1 for i, line in enumerate(sorted((x for x in first if x.split(",")[6]), key=first.get))}

    def text(r):
        return f"{r.invoice_no},{r.stock_code},{r.description},{r.quantity},{r.invoice_date},{r.unit_price},{r.customer_id or ''},{r.country}\n"

    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.shuffle.partitions")}
    try:
        for size, cost, parts in (("128m", "4m", "8"), ("3000", "0", "3"), ("700", "0", "8")):
            for conf, value in zip(before, (size, cost, parts)):
                spark.conf.set(conf, value)
            build = Build.from_csv(spark, path)
            splits = build.raw.count()
            assert splits == len(lines)
            assert sorted(r.source_row_number for r in build.raw.select("source_row_number").collect()) == list(range(2, len(lines) + 2))
            rows = build.numbered.collect()
            assert {text(r): (r.source_row_number, r.copies) for r in rows} == {line: (n, copies[line]) for line, n in first.items()}
            assert {text(r): r.line_id for r in rows if r.customer_id} == known
    finally:
        for conf, value in before.items():
            spark.conf.set(conf, value)
