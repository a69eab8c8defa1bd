"""Values fixed by the register, its coordinate system and its published outputs."""

# --- fixed values: object types, by archive code -----------------------------------------
OBJECT_TYPES = {
    "WPL": "Woonplaats",
    "OPR": "OpenbareRuimte",
    "NUM": "Nummeraanduiding",
    "LIG": "Ligplaats",
    "STA": "Standplaats",
    "PND": "Pand",
    "VBO": "Verblijfsobject",
}
# object types that get a vertex dimension, and those whose WKT text is cut into columns
DIMENSION_TYPES = [
    "Woonplaats",
    "Nummeraanduiding",
    "Ligplaats",
    "Standplaats",
    "Pand",
    "Verblijfsobject",
]
CHUNK_TYPES = ["Woonplaats", "Nummeraanduiding", "Ligplaats", "Standplaats", "Pand"]
# object types written in parts of BATCH_FILES source files each
BATCHED_TYPES = ["Pand", "Verblijfsobject"]
BATCH_FILES = 100

# --- fixed values: XML names -------------------------------------------------------------
XML_ROOT = "sl-bag-extract:bagStand"
XML_ROW = "sl-bag-extract:bagObject"
XML_TYPE_PREFIX = "Objecten:"
ID_FIELD = "Objecten:identificatie"
HISTORY_FIELD = "Objecten:voorkomen"
HISTORY_PATH = ("Historie:Voorkomen", "Historie:voorkomenidentificatie")
HISTORY_FIELDS = (HISTORY_FIELD, *HISTORY_PATH)
GEOMETRY_FIELD = "Objecten:geometrie"

# --- fixed values: geometry output -------------------------------------------------------
GEOMETRY_FIELDS = ["geo_multi_polygon", "geo_polygon", "geo_point"]
WKT_DECIMALS = 16
CHUNK_WIDTH = 30000

# --- fixed values: national grid ---------------------------------------------------------
LAT_MIN, LAT_MAX = 50.75, 53.7
LONG_MIN, LONG_MAX = 3.2, 7.22
GRID_ROWS = 44700
GRID_COLUMNS = 32700

# --- fixed values: RD New to WGS84, Schreutelkamp & Strang van Hees (2001) ----------------
RD_ORIGIN = (155000.0, 463000.0)
RD_SCALE = 1e-5
WGS_ORIGIN_LAT = 52.15517440
WGS_ORIGIN_LONG = 5.38720621
# arc seconds per dX^p * dY^q
LAT_TERMS = {
    (0, 1): 3235.65389,
    (2, 0): -32.58297,
    (0, 2): -0.24750,
    (2, 1): -0.84978,
    (0, 3): -0.06550,
    (2, 2): -0.01709,
    (1, 0): -0.00738,
    (4, 0): 0.00530,
    (2, 3): -0.00039,
    (4, 1): 0.00033,
    (1, 1): -0.00012,
}
LONG_TERMS = {
    (1, 0): 5260.52916,
    (1, 1): 105.94684,
    (1, 2): 2.45656,
    (3, 0): -0.81885,
    (1, 3): 0.05594,
    (3, 1): -0.05607,
    (0, 1): 0.01199,
    (3, 2): -0.00256,
    (1, 4): 0.00128,
    (0, 2): 0.00022,
    (2, 0): -0.00022,
    (5, 0): 0.00026,
}

# --- fixed values: oblique stereographic definition of RD New (EPSG:28992) ---------------
BESSEL_A, BESSEL_INV_F = 6377397.155, 299.1528128
WGS84_A, WGS84_INV_F = 6378137.0, 298.257223563
RD_LAT0 = 52.0 + 9.0 / 60 + 22.178 / 3600
RD_LONG0 = 5.0 + 23.0 / 60 + 15.5 / 3600
RD_K0 = 0.9999079
# position-vector shift to WGS84: metres, arc seconds, parts per million
RD_SHIFT = (565.4171, 50.3319, 465.5524)
RD_ROTATION = (-0.398957, 0.343988, -1.87740)
RD_PPM = 4.0725
