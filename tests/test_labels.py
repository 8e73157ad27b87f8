from pyspark.sql import functions as F

from padron.dictionaries import LABELS_LEGACY, NO_DATA, SECTORS, SIZES, STATES
from padron.functions.labels import (
    band_ordinal, closed_label, long_label, open_label, region_key, size_band,
)


def _map(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    return [r.x for r in df.select(expr(F.col("c")).alias("x")).collect()]


def test_dictionary_sizes():
    assert (len(SECTORS), len(SIZES), len(STATES)) == (9, 7, 32)
    assert "2" not in SECTORS


def test_open_default_keeps_unknown_codes(spark):
    got = _map(spark, ["9", "33", None], lambda c: open_label("cve_entidad", c))
    assert got == ["Ciudad de México", "33", "Sin dato (entidad)"]


def test_leading_zeros_are_not_part_of_a_code(spark):
    got = _map(spark, ["09", "033", "0", "00", "S1"], lambda c: open_label("cve_entidad", c))
    assert got == ["Ciudad de México", "33", "0", "0", "S1"]
    assert _map(spark, ["0", "00"], lambda c: closed_label("sector_economico_1", c))[0] == (
        "Agricultura, ganadería, silvicultura, pesca y caza")


def test_closed_default_hides_unknown_codes(spark):
    got = _map(spark, ["6", "2", None], lambda c: closed_label("sector_economico_1", c))
    assert got == ["Comercio", "Sin dato (sector)", "Sin dato (sector)"]


def test_long_label_follows_the_dimension(spark):
    df = spark.createDataFrame(
        [("patron", "S1"), ("cve_entidad", "1"), ("sector_economico_1", "1"), ("patron", "1"),
         ("patron", None), ("otro", "x")], "v string, c string")
    got = [r.x for r in df.select(long_label(F.col("v"), F.col("c")).alias("x")).collect()]
    assert got == ["1 PT", "Aguascalientes", "Industrias extractivas", "1", NO_DATA["patron"], "x"]


def test_legacy_vocabulary(spark):
    got = _map(spark, ["S1", "S7", None], lambda c: open_label("patron", c, LABELS_LEGACY))
    assert got == ["1 puesto de trabajo", "Más de 1,000 puestos de trabajo",
                   "Sin dato (tamaño patrón)"]


def test_bands_and_their_order(spark):
    values = ["1 PT", "2 a 5 PT", "6 a 50 PT", "51 a 250 PT", "Más de 1,000 PT", "otro", None]
    bands = _map(spark, values, size_band)
    assert bands == ["Micro (1-5)", "Micro (1-5)", "Pequeña (6-50)", "Mediana (51-250)",
                     "Grande (251+)", "Sin dato", "Sin dato"]
    assert _map(spark, bands, band_ordinal) == [1, 1, 2, 3, 4, 5, 5]


def test_region_key(spark):
    assert _map(spark, ["Estado de México", "Jalisco"], region_key) == ["México", "Jalisco"]
