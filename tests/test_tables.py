from types import SimpleNamespace

import pytest

from padron.dictionaries import BAND_OTHER, SIZE_BANDS
from padron.operators.cube import (
    base_cells, marginals, measured, national, national_by_sex, state_sector, wage_marginals,
)
from padron.operators.growth import national_indicators
from padron.operators.reshape import clean_employers
from padron.plans.charts import chart_tables
from padron.plans.report import monthly_report
from padron.plans.sheets import group_sheets, national_sheets
from padron.session import materialise, shared_folder
from padron.sources.employers import employers_long, read_employers
from padron.sources.tables import (
    TableReadError, read_snapshot, read_table, write_per_entity, write_report, write_snapshot,
)
from contract.registro import REFERENCE_MONTH, employer_sheets, regions, registro

SF = "/root/testdata/sf0.001"


def test_read_error_names_the_table(spark, tmp_path):
    with pytest.raises(TableReadError, match="missing_table"):
        read_table(spark, str(tmp_path / "missing_table"))
    with pytest.raises(TableReadError):
        read_snapshot(spark, str(tmp_path / "missing_table"))


def test_snapshot_may_read_what_it_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    assert write_snapshot(spark.range(3), path) == 1
    assert write_snapshot(read_snapshot(spark, path).union(spark.range(3, 5)), path) == 2
    assert sorted(r.id for r in read_snapshot(spark, path).collect()) == [0, 1, 2, 3, 4]
    assert write_snapshot(spark.createDataFrame([("x",)], "s string"), path) == 3
    assert read_snapshot(spark, path).columns == ["s"]


def test_one_output_per_entity(spark, tmp_path):
    df = spark.createDataFrame([("Baja California", 1), ("Colima", 2)], "entidad string, ta int")
    write_per_entity(df, str(tmp_path / "e"), "entidad")
    names = {p.name for p in (tmp_path / "e").iterdir() if p.is_dir()}
    assert names == {"slug=baja_california", "slug=colima"}


def test_reports_have_their_sheets(spark, tmp_path):
    m = measured(registro(spark, SF))
    write_report(group_sheets(marginals(m)), str(tmp_path / "g"))
    write_report(national_sheets(national_indicators(national(m))), str(tmp_path / "n"), "csv")
    states = read_table(spark, str(tmp_path / "g" / "Entidad_Federativa"))
    assert {"ranking_tc_anual", "sign_tc_anual"} <= set(states.columns)
    assert "sign_diff_anual" not in states.columns
    bands = read_table(spark, str(tmp_path / "g" / "Otros"))
    shown = [r["Tamaño de patron"] for r in bands.orderBy("orden").collect()]
    assert shown and shown == [b for b in (*SIZE_BANDS, BAND_OTHER) if b in shown]
    wages = read_table(spark, str(tmp_path / "n" / "Resumen_Salarios"), "csv", header=True)
    assert "sign_diff_mensual_sbc" in wages.columns and wages.count() == 83


def test_report_and_charts_from_stored_tables(spark, tmp_path):
    cells = base_cells(measured(registro(spark, SF)))
    built = {"national": national, "national_by_sex": national_by_sex, "marginals": marginals,
             "state_sector": state_sector, "wage_marginals": wage_marginals}
    for name, table in built.items():
        write_snapshot(table(cells), str(tmp_path / name))
    tables = {name: read_snapshot(spark, str(tmp_path / name)) for name in built}
    sheets = {n: clean_employers(df) for n, df in employer_sheets(registro(spark, SF)).items()}
    report = monthly_report(tables, sheets["tamano"], REFERENCE_MONTH)
    write_report(report, str(tmp_path / "report"))
    assert all(df.count() == 1 for n, df in report.items() if n in (
        "nacional", "entidades", "sectores", "patrones", "sexo"))
    texts = {r.orden: r.texto for r in report["textos"].collect()}
    assert len(texts) in (16, 17) and None not in texts.values()
    assert texts[1].startswith("A noviembre de 2001 hay ")
    charts = chart_tables(tables, employers_long(sheets), regions(spark, SF))
    write_report(charts, str(tmp_path / "charts"))
    assert charts["mapa"].count() == regions(spark, SF).count()
    assert charts["barras_entidades"].count() > 0


def test_employer_sheets_from_csv(spark, tmp_path):
    for name in ("tamano", "sector"):
        spark.createDataFrame([(2024, "Enero", 5)], "`Año` int, Mes string, Total int").write.option(
            "header", True).csv(str(tmp_path / name))
    sheets = read_employers(spark, str(tmp_path), "csv")
    assert str(sheets["sector"].first().fecha) == "2024-01-01"
    assert dict(sheets["tamano"].dtypes)["Total"] == "int"


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    copy = materialise(spark.range(4), "t")
    assert copy.count() == 4 and copy.columns == ["id"]


def test_shared_folder_when_unset():
    local, cluster = (
        SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None),
                        sparkContext=SimpleNamespace(master=master, applicationId=master))
        for master in ("local[2]", "spark://host"))
    assert shared_folder(local) == shared_folder(local)
    with pytest.raises(ValueError):
        shared_folder(cluster)
