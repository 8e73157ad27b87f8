"""Labels, names, limits and report texts, written out here and not taken from the engine."""

from padron import dictionaries as d
from padron.plans import report

SECTORS = [
    ("0", "Agricultura, ganadería, silvicultura, pesca y caza"), ("1", "Industrias extractivas"),
    ("3", "Industrias de la transformación"), ("4", "Industria de la construcción"),
    ("5", "Industria eléctrica, captación y suministro de agua potable"), ("6", "Comercio"),
    ("7", "Transportes y comunicaciones"), ("8", "Servicios para empresas, personas y el hogar"),
    ("9", "Servicios sociales y comunales")]
SIZES = [("S1", "1 PT"), ("S2", "2 a 5 PT"), ("S3", "6 a 50 PT"), ("S4", "51 a 250 PT"),
         ("S5", "251 a 500 PT"), ("S6", "501 a 1,000 PT"), ("S7", "Más de 1,000 PT")]
SIZES_LEGACY = [
    ("S1", "1 puesto de trabajo"), ("S2", "2 a 5 puestos de trabajo"),
    ("S3", "6 a 50 puestos de trabajo"), ("S4", "51 a 250 puestos de trabajo"),
    ("S5", "251 a 500 puestos de trabajo"), ("S6", "501 a 1,000 puestos de trabajo"),
    ("S7", "Más de 1,000 puestos de trabajo")]
STATES = (
    "Aguascalientes, Baja California, Baja California Sur, Campeche, Coahuila de Zaragoza, Colima, "
    "Chiapas, Chihuahua, Ciudad de México, Durango, Guanajuato, Guerrero, Hidalgo, Jalisco, "
    "Estado de México, Michoacán de Ocampo, Morelos, Nayarit, Nuevo León, Oaxaca, Puebla, "
    "Querétaro, Quintana Roo, San Luis Potosí, Sinaloa, Sonora, Tabasco, Tamaulipas, Tlaxcala, "
    "Veracruz de Ignacio de la Llave, Yucatán, Zacatecas").split(", ")
MONTHS = ("enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre "
          "diciembre").split()
EMPLOYERS = [
    ("800 - Patrones con un puesto de trabajo", "1 puesto de trabajo"),
    ("801 - Patrones con 2 y hasta 5 PT", "2 a 5 puestos"),
    ("802 - Patrones con 6 y hasta 50 PT", "6 a 50 puestos"),
    ("803 - Patrones con 51 y hasta 250 PT", "51 a 250 puestos"),
    ("804 - Patrones con 251 y hasta 500 PT", "251 a 500 puestos"),
    ("805 - Patrones con 501 y hasta 1,000 PT", "501 a 1,000 puestos"),
    ("808 - Patrones con más de 1,000 PT", "Más de 1,000 puestos")]


def test_labels():
    assert list(d.SECTORS.items()) == SECTORS
    assert list(d.SIZES.items()) == SIZES
    assert list(d.SIZES_LEGACY.items()) == SIZES_LEGACY
    assert list(d.STATES.items()) == [(str(i), s) for i, s in enumerate(STATES, 1)]
    assert list(d.EMPLOYER_SIZES.items()) == EMPLOYERS
    assert d.NO_DATA == {"patron": "Sin dato (tamaño patrón)",
                         "sector_economico_1": "Sin dato (sector)",
                         "cve_entidad": "Sin dato (entidad)"}
    assert d.REGION_ALIASES == {"Estado de México": "México"}


def test_months_bands_and_limits():
    assert d.MONTHS == MONTHS
    assert d.MONTHS_SHORT == [m[:3] for m in MONTHS]
    assert list(d.SIZE_BANDS.items()) == [
        ("Micro (1-5)", ["1 PT", "2 a 5 PT"]), ("Pequeña (6-50)", ["6 a 50 PT"]),
        ("Mediana (51-250)", ["51 a 250 PT"]),
        ("Grande (251+)", ["251 a 500 PT", "501 a 1,000 PT", "Más de 1,000 PT"])]
    assert d.BAND_OTHER == "Sin dato"
    assert d.RANK_PREFIXES == ["(i)", "(ii)", "(iii)", "(iv)", "(v)"]
    assert report.FLAT == 0.05


BLOCKS = {
    "nacional": {
        "mes_label": "abril de 2026", "mes_nombre": "abril", "anio": 2026, "anio_anterior": 2025,
        "ta_fmt": "1,000", "tp_fmt": "900", "te_fmt": "100", "pct_tp_fmt": "90.0%",
        "pct_te_fmt": "10.0%", "verbo_mensual": "crearon", "abs_mensual_fmt": "11",
        "tipo_cambio_mensual": "crecimiento", "tc_mensual_fmt": "1.1%", "comp_mensual": "mayor",
        "prom_tc_mensual_fmt": "0.5%", "verbo_anual": "perdieron", "abs_anual_fmt": "22",
        "tipo_cambio_anual": "decremento", "tc_anual_fmt": "2.2%", "comp_anual": "menor",
        "prom_tc_anual_fmt": "3.3%", "sustantivo_mensual": "aumento",
        "dir_mensual_tp": "disminución", "tc_mensual_tp_fmt": "0.4%", "dir_anual_tp": "caída",
        "tc_anual_tp_fmt": "0.6%", "dir_mensual_te": "aumento", "tc_mensual_te_fmt": "0.7%",
        "tc_anual_te_fmt": "0.8%", "dir_acumulado": "generación", "acumulado_anio_fmt": "33"},
    "entidades": {
        "ranking_mayor_txt": "(i) A; (ii) B", "ranking_menor_txt": "(i) Z; (ii) Y",
        "entidad_1": "A", "tc_entidad_1": "9.0%", "entidad_2": "B", "tc_entidad_2": "8.0%",
        "entidad_3": "C", "tc_entidad_3": "7.0%", "entidades_nulas_txt": "M y N"},
    "sectores": {
        "mes_label": "abril de 2026", "sector_1": "Comercio", "pct_s1": "40.0%",
        "sector_2": "Servicios", "pct_s2": "30.0%", "sector_3": "Campo", "pct_s3": "20.0%",
        "pct_top3_fmt": "90.0%"},
    "patrones": {
        "mes_nombre": "abril", "anio": 2026, "pat_actual_fmt": "50", "dir_anual": "disminución",
        "tc_anual_fmt": "4.4%", "comp_anual": "menor", "prom_tc_anual_fmt": "1.0%",
        "ref_label": "noviembre de 2023", "pat_ref_fmt": "60", "reduccion_fmt": "10"},
}

TEXTS = [
    "A abril de 2026 hay 1,000 trabajadores asegurados ante el Registro (el 10.0% son eventuales "
    "y el 90.0% son permanentes).",
    "En abril de 2026 se crearon 11 puestos de trabajo con respecto al mes anterior. Esto es un "
    "crecimiento del 1.1%, cifra mayor al promedio histórico (0.5%) para este mes.",
    "En abril de 2026 se perdieron 22 puestos de trabajo con respecto al mismo mes del año "
    "anterior. Esto es un decremento del 2.2%, cifra menor al promedio histórico (3.3%) para este "
    "mes.",
    "Las entidades con mayores tasas de crecimiento anual fueron (i) A; (ii) B.",
    "Durante abril de 2026 se registraron 1,000 puestos de trabajo, lo que representó un aumento "
    "de 11 empleos respecto al mes anterior, equivalente a un crecimiento mensual de 1.1% y con "
    "un decremento anual de 2.2% respecto a abril de 2025.",
    "Por tipo de empleo, el trabajo permanente mostró una disminución mensual de 0.4% y un caída "
    "anual de 0.6%, mientras que el empleo eventual registró un aumento mensual de 0.7% y una "
    "tasa anual de 0.8%.",
    "Permanentes: 900 (90.0%)",
    "Eventuales: 100 (10.0%)",
    "Durante el mes de abril, se registró una generación de 33 nuevos puestos de trabajo durante "
    "2026.",
    "En abril de 2026, se registraron 22 empleos adicionales en comparación con abril de 2025.",
    "Las entidades con mayor crecimiento anual en el empleo asegurado fueron A (9.0%), B (8.0%) "
    "y C (7.0%).",
    "En contraste, M y N registraron un crecimiento nulo (0.0%) en el número de trabajadores "
    "registrados ante el Registro.",
    "Por otro lado, las mayores disminuciones anuales se observaron en: (i) Z; (ii) Y.",
    "Por tipo de sector, los que presentaron mayor aumento anual en puestos de trabajo fueron "
    "Comercio (40.0%), Servicios (30.0%) y Campo (20.0%).",
    "Al interior de los sectores económicos, el sector de Comercio concentró en abril de 2026 el "
    "40.0% del empleo total, seguido de Servicios (30.0%) y Campo (20.0%). En conjunto, estos "
    "tres sectores agrupan aproximadamente el 90.0% del empleo formal en el país.",
    "En abril de 2026 se registraron 50 patrones, lo que representa una disminución anual de "
    "4.4%, cifra menor al promedio histórico (1.0%) para este mes.",
    "Desde noviembre de 2023, el número de patrones inscritos ha pasado de 60 a 50, lo que "
    "equivale a una reducción de 10 registros patronales.",
]


def _texts(spark, institute, **changes):
    blocks = {name: spark.createDataFrame([{**fields, **changes.get(name, {})}])
              for name, fields in BLOCKS.items()}
    rows = report.sentences(blocks, institute).collect()
    return {r.orden: r.texto for r in rows}


def test_report_text(spark):
    assert _texts(spark, "Registro") == dict(enumerate(TEXTS, 1))


def test_report_text_without_name_or_flat_states(spark):
    got = _texts(spark, "", entidades={"entidades_nulas_txt": "ninguna entidad"})
    assert sorted(got) == [i for i in range(1, 18) if i != 12]
    assert got[1] == TEXTS[0].replace(" ante el Registro", "")
