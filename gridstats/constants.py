"""Fixed values. Results depend on these exact numbers and names; do not tune them."""

# Sphere used for great-circle distances, metres.
EARTH_RADIUS_M = 6371010.0

# Kilometres per degree used for the latitude / longitude window of the link step.
KM_PER_DEGREE_LAT = 110.574
KM_PER_DEGREE_LON = 111.320

# Smallest resultant length used by the circular dispersion.
RHO_FLOOR = 1e-9

# Defaults of the link and grid steps, kilometres.
DEFAULT_RADIUS_KM = 10.0
DEFAULT_SPACING_KM = 10.0

# WGS 84 ellipsoid and the UTM projection constants.
WGS84_A = 6378137.0
WGS84_INVERSE_F = 298.257223563
UTM_SCALE = 0.9996
UTM_FALSE_EASTING = 500000.0
UTM_FALSE_NORTHING_SOUTH = 10000000.0

# Segments per quarter circle of a rounded buffer corner.
BUFFER_QUADRANT_SEGMENTS = 16

# Word that stands for "no magnitude column" (any case) in a magnitude list.
UNIT_WEIGHT = "skip"

# Relative error 1/ACCURACY of the approximate median. Fewer than half as many values are ranked exactly, however they are
# dealt over tasks: a sketch shifts ranks from there on.
APPROX_ACCURACY = 20000

# Time columns a catalog looks for, in order of preference.
TIME_CANDIDATES = (
    "firstMeasurementTime",
    "lastMeasurementTime",
    "start_datetime",
    "end_datetime",
    "timestamp",
    "date",
    "time",
)
TIME_PAIR = ("firstMeasurementTime", "lastMeasurementTime")

# Folders that hold query results instead of data (regular expression on the path).
RESULT_FOLDERS = (r"(^|/)query_results/", r"_athena[^/]*/")

# OGC CRS84 as PROJJSON, for the GeoParquet footer.
CRS84 = {
    "$schema": "https://proj.org/schemas/v0.5/projjson.schema.json",
    "type": "GeographicCRS",
    "name": "WGS 84 longitude-latitude",
    "datum": {
        "type": "GeodeticReferenceFrame",
        "name": "World Geodetic System 1984",
        "ellipsoid": {
            "name": "WGS 84",
            "semi_major_axis": 6378137,
            "inverse_flattening": 298.257223563,
        },
    },
    "coordinate_system": {
        "subtype": "ellipsoidal",
        "axis": [
            {"name": "Geodetic longitude", "abbreviation": "Lon", "direction": "east", "unit": "degree"},
            {"name": "Geodetic latitude", "abbreviation": "Lat", "direction": "north", "unit": "degree"},
        ],
    },
    "id": {"authority": "OGC", "code": "CRS84"},
}

# WKB type codes and their names.
GEOMETRY_NAMES = {
    1: "Point",
    2: "LineString",
    3: "Polygon",
    4: "MultiPoint",
    5: "MultiLineString",
    6: "MultiPolygon",
    7: "GeometryCollection",
}

# Catalog vocabulary.
STAC_VERSION = "1.1.0"
TABLE_EXTENSION = "https://stac-extensions.github.io/table/v1.2.0/schema.json"
PARQUET_MEDIA_TYPE = "application/x-parquet"
DEFAULT_LICENSE = "GPL-3.0"
