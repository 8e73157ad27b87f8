"""Fixed values of the registry domain: labels, bands, month names, headings."""

# Code -> label, in the order of the published code lists.
SECTORS = {
    "0": "Agricultura, ganadería, silvicultura, pesca y caza",
    "1": "Industrias extractivas",
    "3": "Industrias de la transformación",
    "4": "Industria de la construcción",
    "5": "Industria eléctrica, captación y suministro de agua potable",
    "6": "Comercio",
    "7": "Transportes y comunicaciones",
    "8": "Servicios para empresas, personas y el hogar",
    "9": "Servicios sociales y comunales",
}

SIZES = {
    "S1": "1 PT",
    "S2": "2 a 5 PT",
    "S3": "6 a 50 PT",
    "S4": "51 a 250 PT",
    "S5": "251 a 500 PT",
    "S6": "501 a 1,000 PT",
    "S7": "Más de 1,000 PT",
}

SIZES_LEGACY = {
    "S1": "1 puesto de trabajo",
    "S2": "2 a 5 puestos de trabajo",
    "S3": "6 a 50 puestos de trabajo",
    "S4": "51 a 250 puestos de trabajo",
    "S5": "251 a 500 puestos de trabajo",
    "S6": "501 a 1,000 puestos de trabajo",
    "S7": "Más de 1,000 puestos de trabajo",
}

STATES = {
    "1": "Aguascalientes",
    "2": "Baja California",
    "3": "Baja California Sur",
    "4": "Campeche",
    "5": "Coahuila de Zaragoza",
    "6": "Colima",
    "7": "Chiapas",
    "8": "Chihuahua",
    "9": "Ciudad de México",
    "10": "Durango",
    "11": "Guanajuato",
    "12": "Guerrero",
    "13": "Hidalgo",
    "14": "Jalisco",
    "15": "Estado de México",
    "16": "Michoacán de Ocampo",
    "17": "Morelos",
    "18": "Nayarit",
    "19": "Nuevo León",
    "20": "Oaxaca",
    "21": "Puebla",
    "22": "Querétaro",
    "23": "Quintana Roo",
    "24": "San Luis Potosí",
    "25": "Sinaloa",
    "26": "Sonora",
    "27": "Tabasco",
    "28": "Tamaulipas",
    "29": "Tlaxcala",
    "30": "Veracruz de Ignacio de la Llave",
    "31": "Yucatán",
    "32": "Zacatecas",
}

# Label of a missing code, per dimension.
NO_DATA = {
    "patron": "Sin dato (tamaño patrón)",
    "sector_economico_1": "Sin dato (sector)",
    "cve_entidad": "Sin dato (entidad)",
}

# Size bands, in display order, and the sizes each one holds.
SIZE_BANDS = {
    "Micro (1-5)": ["1 PT", "2 a 5 PT"],
    "Pequeña (6-50)": ["6 a 50 PT"],
    "Mediana (51-250)": ["51 a 250 PT"],
    "Grande (251+)": ["251 a 500 PT", "501 a 1,000 PT", "Más de 1,000 PT"],
}
BAND_OTHER = "Sin dato"

# The state whose name differs between the tables and the map.
REGION_ALIASES = {"Estado de México": "México"}

# Month names.
MONTHS = [
    "enero", "febrero", "marzo", "abril", "mayo", "junio",
    "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre",
]
MONTHS_SHORT = [
    "ene", "feb", "mar", "abr", "may", "jun",
    "jul", "ago", "sep", "oct", "nov", "dic",
]

# Prefixes of a textual ranking.
RANK_PREFIXES = ["(i)", "(ii)", "(iii)", "(iv)", "(v)"]

# Employer counts by size, column heading -> short label.
EMPLOYER_SIZES = {
    "800 - Patrones con un puesto de trabajo": "1 puesto de trabajo",
    "801 - Patrones con 2 y hasta 5 PT": "2 a 5 puestos",
    "802 - Patrones con 6 y hasta 50 PT": "6 a 50 puestos",
    "803 - Patrones con 51 y hasta 250 PT": "51 a 250 puestos",
    "804 - Patrones con 251 y hasta 500 PT": "251 a 500 puestos",
    "805 - Patrones con 501 y hasta 1,000 PT": "501 a 1,000 puestos",
    "808 - Patrones con más de 1,000 PT": "Más de 1,000 puestos",
}

DIMENSIONS = ("patron", "sector_economico_1", "cve_entidad")

LABELS = {"patron": SIZES, "sector_economico_1": SECTORS, "cve_entidad": STATES}
LABELS_LEGACY = {**LABELS, "patron": SIZES_LEGACY}
