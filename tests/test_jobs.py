"""The command line from loaded CSV to report and sample."""

from __future__ import annotations

import pytest

from skyledger import storage
from skyledger.jobs.cli import main, parser


def test_pipeline(spark, flights, tmp_path):
    raw, cleaned, dims, fact, out = (str(tmp_path / name) for name in
                                     ("raw", "cleaned", "dims", "fact", "out"))
    flights.write.parquet(raw)

    def job(*arguments):
        main(arguments, spark)

    job("clean", "--input", raw, "--output", cleaned, "--dry-run")
    assert not storage.path_exists(spark, cleaned)
    job("clean", "--input", raw, "--output", cleaned, "--partition-by", "Year,Month")
    job("dims", "--input", cleaned, "--output", dims)
    job("fact", "--input", cleaned, "--output", fact, "--dims-folder", dims, "--build",
        "with_ids", "--files", "1")
    job("report", "--input", raw, "--output", out + "/report")
    job("mart", "--input", raw, "--output", out + "/mart")
    job("sample", "--input", raw, "--output", out, "--type", "routes", "--origins", "A00,A01",
        "--destinations", "A01,A02,A03", "--rows", "20", "--format", "csv", "json")
    job("compact", "--input", out + "/sample.parquet", "--files", "1")
    job("summary", f"fact={fact}")

    assert "airline_id" in spark.read.parquet(fact).columns
    assert spark.read.option("header", True).csv(out + "/sample.csv").count() == 20
    assert spark.read.json(out + "/sample.json").count() == 20
    assert storage.path_exists(spark, out + "/report/top_routes.csv")


def test_load_and_convert(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "2001_01.csv").write_text("a,b\n1,x\n2,y\n")
    main(["convert", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "out"),
          "--infer-schema", "--partition-by", "b"], spark)
    assert (tmp_path / "out" / "b=y").is_dir()


def _raw_csv(path, rows):
    """A file with the 109 published columns; ``rows`` hold those that differ from empty."""
    from skyledger.schemas import RAW_FLIGHTS

    names = RAW_FLIGHTS.fieldNames()
    path.write_text("\n".join([",".join(names), *[
        ",".join(str(row.get(name, "")) for name in names) for row in rows]]) + "\n")


def _raw_rows():
    for i in range(24):
        cancelled = i % 8 == 0
        yield {
            "Year": 2020, "Quarter": 1, "Month": 2, "DayofMonth": 1 + i, "DayOfWeek": 1 + i % 7,
            "FlightDate": f"2020-02-{1 + i:02d}", "Reporting_Airline": "AA",
            "DOT_ID_Reporting_Airline": 19805, "IATA_CODE_Reporting_Airline": "AA",
            "Tail_Number": f"N{i}", "Flight_Number_Reporting_Airline": 100 + i,
            "OriginAirportID": 1 + i % 3, "OriginAirportSeqID": 10, "OriginCityMarketID": 5,
            "Origin": f"A{i % 3}", "OriginCityName": "City", "OriginState": "TX",
            "OriginStateFips": 48, "OriginStateName": "Texas", "OriginWac": 74,
            "DestAirportID": 1 + (i + 1) % 3, "DestAirportSeqID": 10, "DestCityMarketID": 5,
            "Dest": f"A{(i + 1) % 3}", "DestCityName": "City", "DestState": "TX",
            "DestStateFips": 48, "DestStateName": "Texas", "DestWac": 74,
            "CRSDepTime": 900, "CRSArrTime": 1100, "Cancelled": "1.00" if cancelled else "0.00",
            "CancellationCode": "B" if cancelled else "", "Diverted": "0.00",
            "CRSElapsedTime": "120.00", "Flights": "1.00", "Distance": "500.00",
            "DistanceGroup": 3, "DivAirportLandings": 0,
        } | ({} if cancelled else {
            "DepTime": 905, "DepDelay": "5.00", "DepDelayMinutes": "5.00", "DepDel15": "0.00",
            "DepartureDelayGroups": 0, "DepTimeBlk": "0900-0959", "TaxiOut": "10.00",
            "WheelsOff": 915, "WheelsOn": 1055, "TaxiIn": "5.00", "ArrTime": 1100,
            "ArrDelay": "0.00", "ArrDelayMinutes": "0.00", "ArrDel15": "0.00",
            "ArrivalDelayGroups": 0, "ArrTimeBlk": "1100-1159", "ActualElapsedTime": "115.00",
            "AirTime": "100.00"})


@pytest.mark.parametrize("types", ["infer", "flights"])
def test_converted_files_go_all_the_way_to_the_fact(spark, tmp_path, types):
    (tmp_path / "in").mkdir()
    rows = list(_raw_rows())
    _raw_csv(tmp_path / "in" / "2020_02.csv", rows)
    raw, cleaned, dims, fact, out = (str(tmp_path / name) for name in
                                     ("raw", "cleaned", "dims", "fact", "out"))
    main(["convert", "--input", str(tmp_path / "in"), "--output", raw, "--types", types], spark)
    assert len(spark.read.parquet(raw).columns) == 109
    main(["clean", "--input", raw, "--output", cleaned], spark)
    assert spark.read.parquet(cleaned).count() == len(rows)
    main(["dims", "--input", cleaned, "--output", dims], spark)
    main(["fact", "--input", cleaned, "--output", fact, "--dims-folder", dims, "--build",
          "with_ids"], spark)
    found = spark.read.parquet(fact)
    assert found.count() == len(rows)
    assert found.where("cancellation_id is not null").count() == 3
    assert found.where("delay_id is not null").count() == 21
    main(["report", "--input", raw, "--output", out], spark)
    assert storage.path_exists(spark, out + "/top_routes.csv")


def test_files_without_a_header_line(spark, tmp_path):
    (tmp_path / "in.csv").write_text("1,x\n2,y\n")
    for types, kind in (("infer", "int"), ("text", "string")):
        target = str(tmp_path / types)
        main(["convert", "--input", str(tmp_path / "in.csv"), "--output", target, "--types", types,
              "--no-header"], spark)
        found = spark.read.parquet(target)
        assert found.dtypes == [("_c0", kind), ("_c1", "string")]
        assert found.count() == 2


def test_load_with_a_ledger(spark, tmp_path):
    from skyledger.schemas import RAW_FLIGHTS

    names = RAW_FLIGHTS.fieldNames()
    values = {"Year": "2020", "Quarter": "1", "Month": "2", "DayofMonth": "3", "DayOfWeek": "1",
              "FlightDate": "2020-02-03", "Reporting_Airline": "AA"}
    rows = [",".join(values.get(name, "") for name in names)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "2020_02.csv").write_text("\n".join([",".join(names), *rows]) + "\n")
    arguments = ["load", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "out"),
                 "--ledger", str(tmp_path / "ledger"), "--start-year", "2020"]
    for _ in range(2):
        main(arguments, spark)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    assert spark.read.parquet(str(tmp_path / "ledger/attempts")).count() == 1


def test_unknown_dimension_is_refused(capsys):
    with pytest.raises(SystemExit):
        parser().parse_args(["dims", "--input", "a", "--output", "b", "--dims", "weather"])
