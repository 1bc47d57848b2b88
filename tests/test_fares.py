"""The fare job on documents in the source's own shape."""

from __future__ import annotations

import gzip
import json
from datetime import datetime

import pytest
from tables import rows, write_text
from pyspark.sql import functions as F

from waymill import storage
from waymill.functions import charge_total, joined, path_stamp, stamp_in_path, translate_codes
from waymill.operators import fare_offers, itinerary_legs
from waymill.plans import fares, run_fares
from waymill.registry import QUERIES
from waymill.registry import fares as queries
from waymill.schemas import FARE_DOCUMENT, ITINERARY_COLUMNS, needed_fare_document
from waymill.sources import read_documents

HOUR = "raw/flights/2025/01/13/03-04"


def offer(url, fare=None, second=None, tax=None, surcharge=None):
    adult = {"Fare": fare, "NaverFare": second, "Tax": tax, "QCharge": surcharge}
    return {"ReserveParameter": {"#cdata-section": url}, "Adult": adult, "Child": {"Fare": "1"}}


def leg(start, stop, carrier, leaves, lands):
    return {"sa": start, "ea": stop, "av": carrier, "fn": "1", "sdt": leaves, "edt": lands, "im": False, "carbonEmission": 1.5}


def document(schedules, fares, airports=None, airlines=None):
    results = {
        "airlines": airlines or {},
        "airports": airports or {},
        "fareTypes": {"A01": "adult"},
        "schedules": [{key: {"id": key, "detail": legs, "journeyTime": ["0225"]} for key, legs in schedules.items()}],
        "fares": {key: {"sch": [key], "fare": fare} for key, fare in fares.items()},
    }
    return {"data": {"internationalList": {"resCnt": 1, "galileoFlag": True, "results": results}}}


def golden():
    return document(
        schedules={
            "S1": [leg("ICN", "NRT", "KE", "202501131030", "202501131255")],
            "S2": [leg("ICN", "KIX", "ZZ", "202501140700", "202501140850")],
            "S3": [leg("ICN", "NRT", "7C", "202501150700", "202501150930")],
        },
        fares={
            "S1": {
                "A01": [offer("u1", "200000", "0", "30000", "5000"), offer("u2", "180000", None, "30000", "5000")],
                "B01": [offer("u3", "1", "0", "0", "0")],
            },
            "S2": {"A01": [offer("u4", "90000", "1000", "20000", "0")]},
            "S3": {"B01": [offer("u5", "1", "0", "0", "0")]},
        },
        airports={"ICN": "인천", "NRT": "나리타"},
        airlines={"KE": "대한항공", "7C": "제주항공"},
    )


def put(folder, name, content):
    text = content if isinstance(content, str) else json.dumps(content, ensure_ascii=False, indent=4)
    write_text(folder / name, text)


def run(spark, tmp_path, **options):
    return run_fares(spark, str(tmp_path / "raw"), str(tmp_path / "out"), **options)


def test_golden_case(spark, tmp_path):
    folder = tmp_path / HOUR
    put(folder, "a.json", golden())
    put(folder, "broken.json", '{"data": {"internationalList": ')
    put(folder, "none_empty_.json", golden())
    put(folder, "notes.txt", golden())
    result = run(spark, tmp_path)
    assert tuple(result.columns) == ITINERARY_COLUMNS
    stamp = "202501130304"
    assert rows(result) == [
        (stamp, "250113", "ICN", "인천", "NRT", "나리타", ["대한항공"], "2501131030", "2501131255", "-", 215000.0, "u2", "-", 0),
        (stamp, "250114", "ICN", "인천", "KIX", None, [None], "2501140700", "2501140850", "-", 111000.0, "u4", "-", 0),
    ]
    exported = spark.read.option("header", True).csv(str(tmp_path / "out/csv"))
    assert tuple(exported.columns) == (*ITINERARY_COLUMNS, "extraction")
    # an empty text is written as "" and read back as such
    assert rows(exported, "url", "amount") == [("u2", "215000.0"), ("u4", "111000.0")]
    (first, second) = rows(exported, "url", "carrier_names")
    assert first == ("u2", "대한항공") and not second[1]


def test_broken_documents_are_counted_and_set_aside(spark, tmp_path):
    put(tmp_path / HOUR, "a.json", golden())
    put(tmp_path / HOUR, "broken.json", '{"data": {"internationalList": ')
    put(tmp_path / HOUR, "other.json", '{"data": "no search"}')
    assert run(spark, tmp_path).count() == 2

    def intake():
        return spark.read.parquet(str(tmp_path / "out/intake"))

    assert rows(intake().filter("broken is null"), "n_documents", "n_broken") == [(3, 2)]
    texts = rows(intake().filter("broken is not null"), "source_path", "broken")
    assert [path.rsplit("/", 1)[1] for path, _ in texts] == ["broken.json", "other.json"] and texts[0][1].startswith('{"data": {')
    # A later run without them replaces the report.
    put(tmp_path / HOUR, "broken.json", golden())
    (tmp_path / HOUR / "other.json").unlink()
    run(spark, tmp_path)
    assert rows(intake(), "n_documents", "n_broken", "broken") == [(2, 0, None)]


def test_work_folder_is_removed(spark, tmp_path, monkeypatch):
    from waymill import storage

    monkeypatch.setattr(storage, "shared_root", lambda _: str(tmp_path / "shared"))
    monkeypatch.setattr(storage, "_session_folders", {})
    put(tmp_path / HOUR, "a.json", golden())
    run(spark, tmp_path)
    (session,) = (tmp_path / "shared/waymill").iterdir()
    assert list(session.iterdir()) == []


def own_folder(monkeypatch, tmp_path):
    monkeypatch.setattr(storage, "shared_root", lambda _: str(tmp_path / "shared"))
    monkeypatch.setattr(storage, "_session_folders", {})


def files_below(folder, pattern):
    return sorted(p for p in folder.rglob(pattern) if not p.name.startswith("."))


def shuffled(spark):
    """Shuffle files of this machine."""
    kept = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {kept.apply(i).getName() for i in range(kept.length()) if kept.apply(i).getName().startswith("shuffle_")}


def test_a_run_leaves_no_shuffle_files(spark, tmp_path):
    put(tmp_path / HOUR, "a.json", golden())
    before = shuffled(spark)
    result = run(spark, tmp_path)
    assert not shuffled(spark) - before and result.count() == 2


def test_parsed_documents_go_before_the_outputs_are_written(spark, tmp_path, monkeypatch):
    own_folder(monkeypatch, tmp_path)
    put(tmp_path / HOUR, "a.json", golden())
    there = {}

    def write(df, path, *arguments):
        there[path.rsplit("/", 1)[1]] = sorted({p.parent.name for p in files_below(tmp_path / "shared", "part-*.parquet")})
        written(df, path, *arguments)

    written = fares.write_partitions
    monkeypatch.setattr(fares, "write_partitions", write)
    assert run(spark, tmp_path).count() == 2
    assert there == {"intake": ["documents"], "parquet": ["itineraries"], "csv": ["itineraries"]}


def test_compressed_documents_and_csv(spark, tmp_path):
    put(tmp_path / HOUR, "plain.json", "neither read nor counted")
    (tmp_path / HOUR / "a.json.gz").write_bytes(gzip.compress(json.dumps(golden(), ensure_ascii=False, indent=4).encode()))
    (tmp_path / HOUR / "b_empty.json.gz").write_bytes(gzip.compress(b"skipped"))
    put(tmp_path / "same" / HOUR, "a.json", golden())
    result = run(spark, tmp_path, files="*.json.gz", csv_codec="gzip")
    same = run_fares(spark, str(tmp_path / "same"), str(tmp_path / "plain"))
    assert rows(result) == rows(same) and len(rows(result)) == 2
    assert rows(spark.read.parquet(str(tmp_path / "out/intake")), "n_documents", "n_broken") == [(1, 0)]
    read = spark.read.option("header", True)
    assert rows(read.csv(str(tmp_path / "out/csv"))) == rows(read.csv(str(tmp_path / "plain/csv")))
    assert files_below(tmp_path / "out/csv", "part-*.csv.gz") and not files_below(tmp_path / "out/csv", "part-*.csv")
    assert files_below(tmp_path / "plain/csv", "part-*.csv") and not files_below(tmp_path / "plain/csv", "*.gz")


def line_items(spark, folder, n=1000):
    """Line items of ten orders and the tables they are joined with."""
    day = F.lit(datetime(2025, 1, 13, 10, 30)).cast("timestamp_ntz")
    spark.range(n).select(
        (F.col("id") % 10).alias("l_orderkey"), F.col("id").alias("l_partkey"), (F.col("id") % 3).alias("l_suppkey"),
        (F.col("id") % 7).cast("int").alias("l_linenumber"), F.lit(1.0).alias("l_quantity"), F.col("id").cast("double").alias("l_extendedprice"),
        F.lit(0.5).alias("l_discount"), F.lit(0.25).alias("l_tax"), F.when(F.col("id") % 4 > 0, "A").otherwise("N").alias("l_returnflag"),
        F.when(F.col("id") % 2 > 0, "O").otherwise("F").alias("l_linestatus"), day.alias("l_shipdate"),
    ).write.parquet(f"{folder}/lineitem.parquet")
    spark.range(3).selectExpr("id AS s_suppkey", "concat('s', id) AS s_name", "cast(id AS int) AS s_nationkey").write.parquet(f"{folder}/supplier.parquet")
    spark.range(3).selectExpr("cast(id AS int) AS n_nationkey", "concat('n', id) AS n_name").write.parquet(f"{folder}/nation.parquet")
    spark.range(1).selectExpr("cast(id AS int) AS r_regionkey").write.parquet(f"{folder}/region.parquet")


def test_the_job_runs_on_bounded_compressed_files(spark, tmp_path, monkeypatch):
    """As text, the documents alone took sixteen times the room of all tables."""
    own_folder(monkeypatch, tmp_path)
    line_items(spark, str(tmp_path / "tables"))
    monkeypatch.setattr(queries, "_DOCUMENTS_PER_FILE", 100, raising=False)
    result = QUERIES["fares_job"](spark, str(tmp_path / "tables"))
    raw = [p for p in files_below(tmp_path / "shared", "part-*.json*") if "/raw/" in str(p)]
    texts = [gzip.decompress(p.read_bytes()).splitlines() if p.suffix == ".gz" else p.read_bytes().splitlines() for p in raw]
    assert sum(map(len, texts)) == 1002 and max(map(len, texts)) <= 100
    assert sum(p.stat().st_size for p in raw) < sum(sum(map(len, lines)) for lines in texts) / 4
    # Orders 1, 3, … are of one extraction, 0, 2, … of the other; every one has an offer that counts.
    assert rows(result.groupBy("extracted_at", "n_documents", "n_broken").count()) == [("202501130304", 501, 1, 500), ("202501140304", 501, 1, 500)]
    cheapest = [min(i for i in range(order, 1000, 10) if i % 4) for order in range(10)]
    assert rows(result, "url", "amount") == sorted([(f"u{i}", i + 0.75) for i in cheapest] * 100, key=repr)


def test_the_documents_of_the_query_go_once_they_are_parsed(spark, tmp_path, monkeypatch):
    own_folder(monkeypatch, tmp_path)
    line_items(spark, str(tmp_path / "tables"))
    before = shuffled(spark)
    result = QUERIES["fare_documents_to_itineraries"](spark, str(tmp_path / "tables"))
    assert files_below(tmp_path / "shared", "part-*") and not files_below(tmp_path / "shared", "part-*.json*")
    assert not shuffled(spark) - before
    assert result.count() == 1000 and result.select("url").distinct().count() == 10


def test_no_documents_give_the_empty_contract(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    assert tuple(run(spark, tmp_path).columns) == ITINERARY_COLUMNS
    absent = read_documents(spark, str(tmp_path / "nowhere"))
    assert absent.columns == ["data", "source_path"] and absent.count() == 0
    skipped = tmp_path / "only" / HOUR
    put(skipped, "empty.json", golden())
    assert run_fares(spark, str(tmp_path / "only"), str(tmp_path / "out2")).count() == 0


def test_equal_amounts_are_decided_by_the_link(spark, tmp_path):
    for name, url in (("a", "u9"), ("b", "u1")):
        put(tmp_path / HOUR, f"{name}.json", document(
            {"S1": [leg("A", "B", "C", "202501131030", "202501131255")]} if name == "a" else {},
            {"S1": {"A01": [offer(url, "10")]}}))
    assert rows(run(spark, tmp_path), "amount", "url") == [(10.0, "u1")]


def test_two_names_for_one_code_do_not_multiply_rows(spark, tmp_path):
    for name, airport in (("a", "Seoul"), ("b", "Incheon")):
        put(tmp_path / HOUR, f"{name}.json", document(
            {"S1": [leg("ICN", "NRT", "KE", "202501131030", "202501131255")]} if name == "a" else {},
            {"S1": {"A01": [offer("u", "1")]}}, airports={"ICN": airport}, airlines={"KE": airport}))
    assert rows(run(spark, tmp_path), "departure_name", "carrier_names") == [("Incheon", ["Incheon"])]


def test_repeated_itinerary_keeps_its_legs(spark, tmp_path):
    """Offers are ranked over all documents of one extraction; legs are not merged."""
    for name, price in (("a", "30"), ("b", "20")):
        put(tmp_path / HOUR, f"{name}.json", document(
            {"S1": [leg("A", "B", "C", "202501131030", "202501131255"), leg("B", "D", "C", "202501131400", "202501131500")]},
            {"S1": {"A01": [offer("u" + price, price)]}}))
    assert rows(run(spark, tmp_path), "arrival_display_code", "amount") == [("B", 20.0)] * 2 + [("D", 20.0)] * 2


def test_extractions_are_ranked_apart(spark, tmp_path):
    for hour, price in (("03-04", "30"), ("04-05", "20")):
        put(tmp_path / "raw/flights/2025/01/13" / hour, "a.json", document(
            {"S1": [leg("A", "B", "C", "202501131030", "202501131255")]},
            {"S1": {"A01": [offer("u", price)]}}, airports={"A": "name " + price}))
    assert rows(run(spark, tmp_path), "extracted_at", "amount", "departure_name") == [
        ("202501130304", 30.0, "name 30"),
        ("202501130405", 20.0, "name 20"),
    ]


def test_append_and_overwrite(spark, tmp_path):
    put(tmp_path / HOUR, "a.json", golden())
    run(spark, tmp_path)
    assert run(spark, tmp_path).count() == 2
    assert run(spark, tmp_path, append=True).count() == 4
    # another extraction has a folder of its own and leaves the first alone
    put(tmp_path / "next/flights/2025/01/13/04-05", "a.json", golden())
    for _ in range(2):
        both = run_fares(spark, str(tmp_path / "next"), str(tmp_path / "out"))
        assert rows(both.groupBy("extracted_at").count()) == [("202501130304", 4), ("202501130405", 2)]
    assert (tmp_path / "out/parquet/extraction=202501130304").is_dir()
    assert spark.read.option("header", True).csv(str(tmp_path / "out/csv")).count() == 6


def test_other_fare_type_and_passenger(spark, tmp_path):
    put(tmp_path / HOUR, "a.json", golden())
    assert rows(run(spark, tmp_path, fare_type="B01"), "url") == [("u3",), ("u5",)]
    assert rows(run(spark, tmp_path, passenger="Child"), "amount") == [(1.0,), (1.0,)]


def test_full_and_needed_schema_agree(spark, tmp_path):
    put(tmp_path / HOUR, "a.json", golden())
    full = read_documents(spark, str(tmp_path / "raw"), FARE_DOCUMENT)
    needed = read_documents(spark, str(tmp_path / "raw"), needed_fare_document())
    assert full.select("data.internationalList.resCnt").first()[0] == 1
    assert rows(itinerary_legs(full)) == rows(itinerary_legs(needed))
    assert rows(fare_offers(full)) == rows(fare_offers(needed))


def test_lines_and_files_agree(spark, tmp_path):
    put(tmp_path / "files" / HOUR, "a.json", golden())
    put(tmp_path / "lines" / HOUR, "a.json", json.dumps(golden(), ensure_ascii=False))
    one = read_documents(spark, str(tmp_path / "files"))
    many = read_documents(spark, str(tmp_path / "lines"), one_per_file=False)
    assert rows(fare_offers(one)) == rows(fare_offers(many))


@pytest.mark.parametrize("text, amount", [("", 0.0), ("abc", 0.0), (None, 0.0), ("1.5", 1.5), ("2", 2.0)])
def test_charges(spark, text, amount):
    row = spark.createDataFrame([(text, "1")], "a STRING, b STRING").select(charge_total("a", "b").alias("sum")).first()
    assert row["sum"] == amount + 1.0


def test_column_functions(spark):
    row = spark.range(1).select(
        path_stamp(F.lit("raw_data/flights/2025/01/13/03-04/x.json")).alias("stamp"),
        stamp_in_path(F.lit("s3://b/any/depth/2025/01/13/03-04/x.json")).alias("found"),
        stamp_in_path(F.lit("s3://b/none.json")).alias("absent"),
        joined(F.array(F.lit("a"), F.lit(None), F.lit("b"))).alias("list"),
        joined(F.array(F.lit(None).cast("string"))).alias("nothing"),
        translate_codes(F.array(F.lit("KE"), F.lit("ZZ")), {"KE": "name"}).alias("names"),
        translate_codes(F.array(F.lit("KE")), {}).alias("no_names"),
    ).first()
    assert tuple(row) == ("202501130304", "202501130304", "", "a,b", "", ["name", None], [None])
