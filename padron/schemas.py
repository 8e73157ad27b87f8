"""Schemas of the monthly microdata and of the tables built from it."""

from pyspark.sql import types as T

COUNT = T.LongType()
MONEY = T.DecimalType(18, 2)

#: Types of the microdata columns the engine knows; any other column is text.
MICRODATA_TYPES = {
    "cve_entidad": T.StringType(),
    "sector_economico_1": T.StringType(),
    "patron": T.StringType(),
    "sexo": T.IntegerType(),
    "ta": COUNT,
    "teu": COUNT,
    "tec": COUNT,
    "tpu": COUNT,
    "tpc": COUNT,
    "masa_sal_ta": MONEY,
    "ta_sal": COUNT,
}

#: Keys that identify one row of each aggregate table.
TABLE_KEYS = {
    "national": ("date",),
    "national_by_sex": ("date", "sexo"),
    "marginals": ("date", "variable", "categoria"),
    "marginals_by_sex": ("date", "variable", "categoria", "sexo"),
    "state_sector": ("date", "entidad", "sector"),
    "wage_marginals": ("date", "variable", "categoria"),
    "wage_marginals_by_sex": ("date", "variable", "categoria", "sexo"),
}
