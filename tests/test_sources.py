import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from padron.operators.cube import measured, national
from padron.sources.catalog import (
    file_catalog, in_range, missing_months, new_months, period_from_name, source_manifest,
    source_name,
)
from padron.sources.microdata import (
    dealt_by_month, read_header, read_microdata, size_column, write_microdata)

HEADER = "cve_entidad|sector_economico_1|tamaño_patron|sexo|ta|teu|tec|tpu|tpc|masa_sal_ta|ta_sal"


def write_file(folder, name, lines, header=HEADER):
    path = folder / name
    path.write_bytes("\n".join([header, *lines, ""]).encode("latin-1"))
    return path


@pytest.fixture
def inputs(tmp_path):
    write_file(tmp_path, "asg-2024-01-31.csv", ["1|0|S1|1|5|1|2|1|1|50.25|5", "|NA|S2|2|3|||||0|3"])
    write_file(tmp_path, "asg-2024-02-29.csv", ['""|2|S7|1|2|||1|1|9.10|0'],
               HEADER.replace("tamaño_patron", "TAMANO_PATRON"))
    write_file(tmp_path, "asg-2024-13-01.csv", ["1|0|S1|1|5|1|2|1|1|50.25|5"])
    (tmp_path / "otro.csv").write_text("x\n1\n")
    return tmp_path


def test_catalog_keeps_valid_months(spark, inputs):
    rows = {r.archivo: r.date for r in file_catalog(spark, str(inputs)).collect()}
    assert rows == {"asg-2024-01-31.csv": date(2024, 1, 1), "asg-2024-02-29.csv": date(2024, 2, 1)}


def test_microdata_nulls_types_and_drift(spark, inputs):
    paths = [r.ruta for r in file_catalog(spark, str(inputs)).collect()]
    df = read_microdata(spark, paths)
    rows = {(r.date, r.sexo, r.ta): r for r in df.collect()}
    one, two, three = (rows[k] for k in ((date(2024, 1, 1), 1, 5), (date(2024, 1, 1), 2, 3),
                                         (date(2024, 2, 1), 1, 2)))
    assert (one.cve_entidad, one.patron, str(one.masa_sal_ta)) == ("1", "S1", "50.25")
    assert two.cve_entidad is None and two.sector_economico_1 is None and two.teu is None
    assert three.cve_entidad == "" and three.patron == "S7"  # quoted empty text is not missing
    assert (three.year, three.month, three.archivo) == (2024, 2, "asg-2024-02-29.csv")


def test_latin1_header(spark, inputs):
    assert "tamaño_patron" in read_header(spark, str(inputs / "asg-2024-01-31.csv"))


def test_national_from_files(spark, inputs):
    paths = [r.ruta for r in file_catalog(spark, str(inputs)).collect()]
    rows = {r.date: r for r in national(measured(read_microdata(spark, paths))).collect()}
    jan, feb = rows[date(2024, 1, 1)], rows[date(2024, 2, 1)]
    assert (jan.ta, jan.te, jan.tp, jan.sbc_prom) == (8, 3, 2, 50.25 / 5)
    assert (feb.ta, feb.te, feb.tp, feb.sbc_prom) == (2, 0, 2, None)


def test_size_column_must_be_single():
    assert size_column(["a", "Tamano_Patron"]) == "Tamano_Patron"
    with pytest.raises(ValueError):
        size_column(["x_patron", "y_patron"])
    with pytest.raises(ValueError):
        size_column(["x"])


def test_no_files(spark):
    with pytest.raises(FileNotFoundError):
        read_microdata(spark, [])


def test_source_names(spark):
    df = spark.createDataFrame([
        ("file:/a/asg-2024-01-31.csv",), ("/a/archivo=asg-2024-01-31.csv/part-0.csv",),
        ("/a/asg-2024-01-31.csv.bak",), ("/a/b.csv",)], "p string")
    got = [r.n for r in df.select(source_name("p").alias("n")).collect()]
    assert got == ["asg-2024-01-31.csv", "asg-2024-01-31.csv", None, None]
    periods = spark.createDataFrame([("asg-1999-12-31.csv",)], "n string").withColumns(
        period_from_name("n")).first()
    assert (periods.year, periods.month, periods.date) == (1999, 12, date(1999, 12, 1))


def _catalog(spark, *names):
    df = spark.createDataFrame([(n,) for n in names], "archivo string")
    return df.withColumns(period_from_name("archivo")).select("archivo", "date")


def test_new_months(spark):
    cat = _catalog(spark, "asg-2024-01-31.csv", "asg-2024-02-29.csv", "asg-2024-03-31.csv")
    history = spark.createDataFrame([(date(2024, 2, 1),), (None,)], "date date")
    assert {r.archivo[4:11] for r in new_months(cat, history).collect()} == {"2024-01", "2024-03"}
    assert [r.archivo for r in new_months(cat, history, "latest").collect()] == ["asg-2024-03-31.csv"]
    assert new_months(cat, None).count() == 3
    with pytest.raises(ValueError):
        new_months(cat, None, "some")


def test_range_is_inclusive(spark):
    cat = _catalog(spark, "asg-2024-01-31.csv", "asg-2024-02-29.csv", "asg-2024-03-31.csv")
    got = in_range(cat, date(2024, 1, 31), date(2024, 2, 29))
    assert {r.archivo[4:11] for r in got.collect()} == {"2024-01", "2024-02"}


def test_manifest_and_missing(spark):
    bounds = spark.createDataFrame([(date(2023, 12, 1), date(2024, 2, 15))], "start date, end date")
    manifest = source_manifest(bounds, "https://example.org/")
    rows = {r.date: r for r in manifest.collect()}
    assert rows[date(2024, 2, 1)].archivo == "asg-2024-02-29.csv"
    assert rows[date(2023, 12, 1)].url == "https://example.org/asg-2023-12-31.csv"
    lost = missing_months(manifest, _catalog(spark, "asg-2024-01-31.csv"))
    assert {r.date for r in lost.collect()} == {date(2023, 12, 1), date(2024, 2, 1)}


def test_written_sources_read_back(spark, inputs, tmp_path):
    paths = [r.ruta for r in file_catalog(spark, str(inputs)).collect()]
    df = read_microdata(spark, paths)
    out = str(tmp_path / "out")
    write_microdata(df, out)
    back = read_microdata(spark, [r.ruta for r in file_catalog(spark, out).collect()])
    key = sorted(set(df.columns) - {"file_path"})
    assert sorted(map(str, df.select(key).collect())) == sorted(map(str, back.select(key).collect()))
    assert back.filter(F.col("archivo").isNull()).isEmpty()


def _totals(spark, *paths):
    rows = national(measured(read_microdata(spark, [str(p) for p in paths]))).collect()
    return {r.date.month: (r.ta, r.te, r.tp, r.sbc_prom) for r in rows}


def test_numbers_may_have_a_zero_fraction(spark, tmp_path):
    file = write_file(tmp_path, "asg-2024-01-31.csv", [
        "1|0|S1|1.0|12.0|1|2.00|1|1|50.25|5", "1|0|S1|1|5||||| |0"])
    assert _totals(spark, file) == {1: (17, 3, 2, 50.25 / 5)}


@pytest.mark.parametrize("line", [
    "1|0|S1|1|x|1|2|1|1|50.25|5", "1|0|S1|1|5.5|1|2|1|1|50.25|5", "1|0|S1|1|5|1|2|1|1|mucho|5",
    "1|0|S1|1|5|1|2|1|1|50.25", "1|0|S1|1|5|1|2|1|1|50.25|5|9"])
def test_bad_lines_stop_the_read(spark, tmp_path, line):
    write_file(tmp_path, "asg-2024-01-31.csv", ["1|0|S1|1|5|1|2|1|1|50.25|5"])
    write_file(tmp_path, "asg-2024-02-29.csv", ["1|0|S1|1|5|1|2|1|1|50.25|5", line])
    with pytest.raises(Exception, match="asg-2024-02-29.csv"):
        _totals(spark, *sorted(tmp_path.glob("*.csv")))


def test_two_size_columns_name_the_file(spark, tmp_path):
    file = write_file(tmp_path, "asg-2024-01-31.csv", [], HEADER + "|otro_patron")
    with pytest.raises(ValueError, match="asg-2024-01-31.csv"):
        read_microdata(spark, [str(file)])


def test_part_files_may_order_columns_differently(spark, tmp_path):
    source = tmp_path / "asg-2024-01-31.csv"
    source.mkdir()
    write_file(source, "part-0.csv", ["9|0|S3|2|5|1|2|1|1|50.25|5"])
    write_file(source, "part-1.csv", ["5|50.25|1|1|2|1|5|2|S3|0|9"],
               "|".join(reversed(HEADER.replace("tamaño", "TAMANO").split("|"))))
    rows = read_microdata(spark, [str(source)]).drop("file_path").collect()
    assert len(rows) == 2 and rows[0] == rows[1]
    assert (rows[0].cve_entidad, rows[0].patron, rows[0].sexo) == ("9", "S3", 2)


#: How a count and an amount may be written, with their values.
SPELLINGS = [("12", 12), ("12.0", 12), (" 12", 12), ("+5", 5), ("007", 7), ("-3", -3), ("1e3", 1000),
             ("-0", 0), ("", None), ("NA", None), ("  ", None), ("9223372036854775807", 2 ** 63 - 1)]
AMOUNTS = [("12", "12.00"), ("12.5", "12.50"), ("12.50", "12.50"), (" 1.005", "1.01"), ("+0.1", "0.10"),
           ("-7.25", "-7.25"), ("1e2", "100.00"), ("", None), ("NA", None)]


def test_spellings_of_numbers(spark, tmp_path):
    lines = [f"1|1|S1|1|{a}|||||1.00|1" for a, _ in SPELLINGS]
    lines += [f"1|1|S1|1|1|||||{m}|1" for m, _ in AMOUNTS]
    path = write_file(tmp_path, "asg-2020-01-31.csv", lines)
    rows = read_microdata(spark, [str(path)]).select(
        "ta", F.col("masa_sal_ta").cast("string").alias("m")).collect()
    assert [r.ta for r in rows[:len(SPELLINGS)]] == [v for _, v in SPELLINGS]
    assert [r.m for r in rows[len(SPELLINGS):]] == [v for _, v in AMOUNTS]


def test_reading_makes_no_method_too_large_to_compile(spark, tmp_path):
    """The JVM interprets methods of more than 8,000 bytes, however often they run."""
    path = write_file(tmp_path, "asg-2020-01-31.csv", ["1|1|S1|1|1|||||1.00|1"])
    plan = read_microdata(spark, [str(path)])._jdf.queryExecution()
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:\s*(\d+)", plan.explainString(mode))]
    assert max(sizes, default=0) < 8_000


def test_names_of_sources_are_not_shuffled(spark):
    micro = spark.range(10).selectExpr("DATE'2020-01-01' AS date", "CAST(id AS STRING) AS patron",
                                       "id AS ta")
    rows = dealt_by_month(micro)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "asg-" in plan.split("RebalancePartitions")[0]
    assert "asg-" not in plan.split("RebalancePartitions")[1]
    assert {r.archivo for r in rows.collect()} == {"asg-2020-01-31.csv"}


def test_counts_are_read_as_such_and_other_spellings_again(spark, tmp_path):
    plain = "1|0|S1|1|12|1|1|1|1|12.50|12"
    other = ["1|0|S1|1|12.0|1|1|1|1|12.50|+12", "1|0|S1|1| 12|1|1|1|1|12.5|012",
             '1|0|S1|1|"12"|1|1|1|1|12.500|"12.0"', "1|0|S1|1|12|1|1|1|1|12.4999999|12"]
    path = write_file(tmp_path, "asg-2024-01-31.csv", [plain, *other])
    rows = read_microdata(spark, [str(path)])
    assert [(r.ta, str(r.masa_sal_ta), r.ta_sal) for r in rows.collect()] == [(12, "12.50", 12)] * 5
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "ta:bigint" in plan.split("ReadSchema: ")[1]
