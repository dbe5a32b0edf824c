"""Names, ids and table schemas shared by all operators."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Band order, class table, training areas and thresholds that the
# results depend on.
# ---------------------------------------------------------------------------
SPECTRAL_BANDS = ["B02", "B03", "B04", "B08", "B11", "B12"]
SCENE_BANDS = ["B02", "B03", "B04", "B08", "B11", "B12", "SCL"]

BAND_NAMES = [
    "B02", "B03", "B04", "B08", "B11", "B12",
    "NDVI", "NDBI", "NDWI", "SAVI", "BSI", "EVI", "MNDWI", "UI", "NBI",
    "RedGreen", "SR", "SWIRRatio",
    "Elevation", "Slope", "Aspect_sin", "Aspect_cos", "PlanCurv", "ProfCurv", "TRI", "TPI",
    "NDVI_std", "NIR_mean", "NIR_std",
]

# class_id, class_name, (red, green, blue), hex colour; ids follow alphabetical name order
CLASSES = [
    (0, "Agricultural", (200, 190, 60), "#C8BE3C"),
    (1, "Bare_Soil", (180, 150, 100), "#B49664"),
    (2, "Industrial", (150, 50, 180), "#9632B4"),
    (3, "Urban", (220, 50, 50), "#DC3232"),
    (4, "Vegetation", (50, 160, 50), "#32A032"),
    (5, "Water", (50, 100, 220), "#3264DC"),
]
NODATA_CLASS = 255
NODATA_RGB = (200, 200, 200)
BARE_SOIL_ID = 1
VEGETATION_ID = 4
WATER_ID = 5

# order in which class reports list their rows
REPORT_CLASS_ORDER = ["Urban", "Vegetation", "Agricultural", "Bare_Soil", "Water", "Industrial"]
KEY_FEATURES = ["NDVI", "NDBI", "NDWI", "BSI", "Elevation", "Slope"]

AOI_WGS84 = (-112.5, 33.2, -111.7, 33.7)  # west, south, east, north
DATE_RANGE = ("2023-06-01", "2023-08-31")
MAX_CLOUD = 5.0
MAX_SCENES = 3
LAT_WATER_THRESHOLD = 33.55
LON_REFERENCE = -111.9
EVI_RANGE = (-1.0, 2.0)
SIMPLIFY_TOLERANCE_M = 20.0
RANDOM_STATE = 42

# class, polygon class id, centre lon, centre lat, half width, half height (degrees), description
TRAINING_AREAS = [
    ("Urban", 1, -111.927, 33.494, 0.006, 0.004, "Old Town Scottsdale"),
    ("Urban", 1, -111.928, 33.420, 0.006, 0.004, "Tempe ASU / Mill Ave district"),
    ("Urban", 1, -111.832, 33.415, 0.005, 0.004, "Mesa Downtown"),
    ("Urban", 1, -111.921, 33.638, 0.006, 0.004, "N Scottsdale / Kierland"),
    ("Vegetation", 2, -111.948, 33.459, 0.005, 0.004, "Papago Park"),
    ("Vegetation", 2, -111.876, 33.556, 0.006, 0.004, "McCormick Ranch Golf Club"),
    ("Vegetation", 2, -111.845, 33.598, 0.006, 0.005, "McDowell Mountain Regional Park"),
    ("Vegetation", 2, -111.781, 33.635, 0.005, 0.004, "Scottsdale native desert preserve"),
    ("Agricultural", 3, -111.752, 33.374, 0.007, 0.005, "East Mesa irrigated farmland"),
    ("Agricultural", 3, -111.748, 33.357, 0.006, 0.004, "Gilbert irrigated fields"),
    ("Agricultural", 3, -111.736, 33.407, 0.006, 0.004, "East Mesa SRP irrigation area"),
    ("Bare_Soil", 4, -111.835, 33.575, 0.006, 0.005, "McDowell Mountains rocky desert"),
    ("Bare_Soil", 4, -111.802, 33.510, 0.005, 0.004, "Scottsdale desert preserve scrub"),
    ("Bare_Soil", 4, -111.742, 33.485, 0.005, 0.004, "Sonoran Desert open scrub"),
    ("Bare_Soil", 4, -111.752, 33.427, 0.005, 0.004, "East Mesa undeveloped caliche"),
    ("Bare_Soil", 4, -111.984, 33.625, 0.006, 0.005, "Cave Creek desert scrub — north"),
    ("Bare_Soil", 4, -111.921, 33.660, 0.007, 0.005, "North Scottsdale / Carefree desert"),
    ("Bare_Soil", 4, -111.855, 33.670, 0.007, 0.004, "McDowell Sonoran Preserve north"),
    ("Bare_Soil", 4, -111.776, 33.658, 0.006, 0.004, "Fort McDowell desert flats — north"),
    ("Bare_Soil", 4, -111.940, 33.585, 0.006, 0.004, "North Phoenix desert — Cave Creek Rd"),
    ("Bare_Soil", 4, -111.806, 33.607, 0.005, 0.004, "North Scottsdale desert ridge"),
    ("Water", 5, -111.921, 33.428, 0.010, 0.002, "Tempe Town Lake (Salt River impoundment)"),
    ("Water", 5, -111.860, 33.393, 0.008, 0.002, "Salt River channel west"),
    ("Water", 5, -111.810, 33.390, 0.007, 0.002, "Salt River channel east"),
    ("Industrial", 6, -111.906, 33.619, 0.006, 0.004, "Scottsdale Airpark"),
    ("Industrial", 6, -111.860, 33.412, 0.005, 0.004, "Mesa Superstition industrial"),
    ("Industrial", 6, -111.940, 33.474, 0.005, 0.003, "East Phoenix industrial"),
    ("Industrial", 6, -111.844, 33.369, 0.005, 0.003, "Chandler industrial corridor"),
]
# ---------------------------------------------------------------------------

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])

AREA_SCHEMA = T.StructType(
    [
        T.StructField("class", T.StringType()),
        T.StructField("class_id", T.IntegerType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("dlon", T.DoubleType()),
        T.StructField("dlat", T.DoubleType()),
        T.StructField("desc", T.StringType()),
    ]
)

POLYGON_SCHEMA = T.StructType(
    [
        T.StructField("class", T.StringType()),
        T.StructField("class_id", T.IntegerType()),
        T.StructField("desc", T.StringType()),
        T.StructField("width_m", T.DoubleType()),
        T.StructField("height_m", T.DoubleType()),
        T.StructField("ring", T.ArrayType(POINT)),
    ]
)

TRAINING_SCHEMA = T.StructType(
    [T.StructField("class", T.StringType()), T.StructField("class_id", T.IntegerType())]
    + [T.StructField(band, T.DoubleType()) for band in BAND_NAMES]
)

AREA_TABLE_SCHEMA = T.StructType(
    [
        T.StructField("class_id", T.IntegerType()),
        T.StructField("class_name", T.StringType()),
        T.StructField("pixels", T.LongType()),
        T.StructField("area_km2", T.DoubleType()),
        T.StructField("pct", T.DoubleType()),
    ]
)

CLASS_SCHEMA = T.StructType(
    [
        T.StructField("class_id", T.IntegerType(), False),
        T.StructField("class_name", T.StringType(), False),
        T.StructField("red", T.IntegerType(), False),
        T.StructField("green", T.IntegerType(), False),
        T.StructField("blue", T.IntegerType(), False),
        T.StructField("hex", T.StringType(), False),
    ]
)


def class_dimension(spark):
    """The six-row class table: id, name and display colour."""
    rows = [(cid, name, *rgb, colour) for cid, name, rgb, colour in CLASSES]
    return spark.createDataFrame(rows, CLASS_SCHEMA)


def training_areas(spark):
    """The inline training areas: centre, half extents and class of each box (SRC11)."""
    return spark.createDataFrame(TRAINING_AREAS, AREA_SCHEMA)
