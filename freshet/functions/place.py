"""Grid cells, tiles, positions and geometry columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

CELL_M = 100
KEY_STRIDE = 10_000
TILE_M = 50_000
OS_LETTERS = "ABCDEFGHJKLMNOPQRSTUVWXYZ"
EARTH_KM = 6371.0088


def cell_key(easting: Column, northing: Column) -> Column:
    return (F.floor(northing / CELL_M) * KEY_STRIDE + F.floor(easting / CELL_M)).cast("long")


def cell_easting(key: Column) -> Column:
    return F.pmod(key, F.lit(KEY_STRIDE)) * CELL_M


def cell_northing(key: Column) -> Column:
    return F.floor(key / KEY_STRIDE) * CELL_M


def tile_code(easting: Column, northing: Column) -> Column:
    """The 50 km tile holding a point: two grid letters, then the tens of km; blank off the lettered grid."""
    col, row = F.floor(easting / 500_000) + 2, 3 - F.floor(northing / 500_000)
    within_e, within_n = F.pmod(easting, F.lit(500_000)), F.pmod(northing, F.lit(500_000))
    small = (4 - F.floor(within_n / 100_000)) * 5 + F.floor(within_e / 100_000)
    letter = lambda i: F.substring(F.lit(OS_LETTERS), (i + 1).cast("int"), F.lit(1))
    half = lambda v: F.when(F.pmod(v, F.lit(100_000)) >= TILE_M, "5").otherwise("0")
    code = F.concat(letter(row * 5 + col), letter(small), half(easting), half(northing))
    return F.when(col.between(0, 4) & row.between(0, 4), code).otherwise("")


def tile_west(code: Column) -> Column:
    big, small = _letter_index(code, 1), _letter_index(code, 2)
    return (big % 5 - 2) * 500_000 + (small % 5) * 100_000 + F.substring(code, 3, 1).cast("int") * 10_000


def tile_south(code: Column) -> Column:
    big, small = _letter_index(code, 1), _letter_index(code, 2)
    return ((3 - F.floor(big / 5)) * 500_000 + (4 - F.floor(small / 5)) * 100_000
            + F.substring(code, 4, 1).cast("int") * 10_000)


def _letter_index(code: Column, position: int) -> Column:
    return F.position(F.substring(F.upper(code), position, 1), F.lit(OS_LETTERS)) - 1


def tile_from_name(name: Column) -> Column:
    """``RoFRS_SE50_v202606`` gives ``SE50``; NULL when the name holds no tile."""
    found = F.regexp_extract(name, r"_([A-Z]{2}\d{2})_v\d+", 1)
    return F.when(found != "", found)


def is_present_day(name: Column) -> Column:
    return ~F.lower(name).contains("climate_change")


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat, half_lon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_lon), 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(a))


def _degree_readings(digits: Column, sign: Column, low: float, high: float) -> Column:
    """Every split of a digit run into degrees and minutes (under 60) that falls in the range."""
    def at(k: Column) -> Column:
        degrees = F.coalesce(F.substring(digits, F.lit(1), k.cast("int")).try_cast("int"), F.lit(0))
        minutes = F.substring(digits, (k + 1).cast("int"), F.length(digits)).try_cast("int")
        return F.when(minutes < 60, sign * (degrees + minutes / 60.0))

    values = F.transform(F.sequence(F.lit(0), F.length(digits) - 1), at)
    return F.array_distinct(F.filter(values, lambda v: v.isNotNull() & v.between(low, high)))


def gauge_positions(code: Column) -> Column:
    """Every plausible (lat, lon) of a tide-gauge code such as ``5338N011W``; an empty array when it is not one."""
    text = F.upper(F.regexp_replace(F.coalesce(code, F.lit("")), " ", ""))
    shape = r"^(\d{3,4})([NS])(\d{2,4})([EW])$"
    part = lambda i: F.regexp_extract(text, shape, i)
    north = F.when(part(2) == "N", 1).otherwise(-1)
    east = F.when(part(4) == "W", -1).otherwise(1)
    lats = _degree_readings(part(1), north, 49.0, 61.0)
    lons = _degree_readings(part(3), east, -9.0, 2.5)
    pairs = F.flatten(F.transform(lats, lambda la: F.transform(lons, lambda lo: F.struct(la.alias("lat"), lo.alias("lon")))))
    empty = F.filter(F.array(F.struct(F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"))), lambda p: p.lat > 1)
    return F.when(text.rlike(shape), pairs).otherwise(empty)


def to_national_grid(lat: Column, lon: Column) -> tuple[Column, Column]:
    """WGS84 degrees to national-grid metres: Helmert shift then transverse Mercator (published formulas, about 5 m)."""
    a1, b1 = 6378137.0, 6356752.314245
    a2, b2 = 6377563.396, 6356256.909
    phi, lam = F.radians(lat), F.radians(lon)
    e1 = 1 - (b1 * b1) / (a1 * a1)
    nu1 = a1 / F.sqrt(1 - e1 * F.pow(F.sin(phi), 2))
    x, y, z = nu1 * F.cos(phi) * F.cos(lam), nu1 * F.cos(phi) * F.sin(lam), (1 - e1) * nu1 * F.sin(phi)
    # The published seven-parameter shift.
    tx, ty, tz, scale = -446.448, 125.157, -542.060, 1 + 20.4894e-6
    arc = 4.84813681109536e-06
    rx, ry, rz = -0.1502 * arc, -0.2470 * arc, -0.8421 * arc
    x2 = tx + scale * x - rz * y + ry * z
    y2 = ty + rz * x + scale * y - rx * z
    z2 = tz - ry * x + rx * y + scale * z
    e2 = 1 - (b2 * b2) / (a2 * a2)
    p = F.sqrt(x2 * x2 + y2 * y2)
    lat2 = F.atan2(z2, p * (1 - e2))
    for _ in range(3):
        nu = a2 / F.sqrt(1 - e2 * F.pow(F.sin(lat2), 2))
        lat2 = F.atan2(z2 + e2 * nu * F.sin(lat2), p)
    return _transverse_mercator(lat2, F.atan2(y2, x2), a2, b2, e2)


def _transverse_mercator(phi: Column, lam: Column, a: float, b: float, e2: float) -> tuple[Column, Column]:
    # National-grid origin and scale.
    f0, n0, e0 = 0.9996012717, -100000.0, 400000.0
    phi0, lam0 = 0.8552113334772214, -0.03490658503988659
    n = (a - b) / (a + b)
    s, c, t = F.sin(phi), F.cos(phi), F.tan(phi)
    nu = a * f0 / F.sqrt(1 - e2 * s * s)
    rho = a * f0 * (1 - e2) / F.pow(1 - e2 * s * s, F.lit(1.5))
    eta2 = nu / rho - 1
    d, m = phi - phi0, phi + phi0
    arc = b * f0 * (
        (1 + n + 1.25 * n**2 + 1.25 * n**3) * d
        - (3 * n + 3 * n**2 + 21 / 8 * n**3) * F.sin(d) * F.cos(m)
        + (15 / 8 * (n**2 + n**3)) * F.sin(2 * d) * F.cos(2 * m)
        - (35 / 24 * n**3) * F.sin(3 * d) * F.cos(3 * m))
    l = lam - lam0
    northing = (arc + n0 + nu / 2 * s * c * l**2
                + nu / 24 * s * F.pow(c, 3) * (5 - t * t + 9 * eta2) * l**4
                + nu / 720 * s * F.pow(c, 5) * (61 - 58 * t * t + F.pow(t, 4)) * l**6)
    easting = (e0 + nu * c * l + nu / 6 * F.pow(c, 3) * (nu / rho - t * t) * l**3
               + nu / 120 * F.pow(c, 5) * (5 - 18 * t * t + F.pow(t, 4) + 14 * eta2 - 58 * t * t * eta2) * l**5)
    return easting, northing


# ---- GeoJSON -------------------------------------------------------------------------------------------------

# Declared shape words and the geometry they name.
DECLARED = {
    "polygon": "Polygon", "multipolygon": "MultiPolygon", "linestring": "LineString", "multilinestring": "MultiLineString",
    "polyline": "LineString", "line": "LineString",
}


def nesting_depth(coordinates_json: Column) -> Column:
    """Depth of a coordinate array, from its leading brackets."""
    lead = F.regexp_extract(F.regexp_replace(coordinates_json, r"\s+", ""), r"^(\[*)", 1)
    return F.length(lead)


def geometry_type(declared: Column, coordinates_json: Column) -> Column:
    """The declared type when its nesting agrees, else the type the nesting implies, else NULL."""
    from freshet.functions.risk import lookup

    depth = nesting_depth(coordinates_json)
    named = lookup(F.lower(F.trim(F.coalesce(declared, F.lit("")))), DECLARED)
    expected = lookup(named, {"LineString": 2, "Polygon": 3, "MultiLineString": 3, "MultiPolygon": 4})
    implied = lookup(depth, {2: "LineString", 3: "Polygon", 4: "MultiPolygon"})
    return F.when(expected == depth, named).otherwise(implied)


def geojson(kind: Column, coordinates_json: Column) -> Column:
    return F.when(kind.isNotNull(), F.concat(F.lit('{"type": "'), kind, F.lit('", "coordinates": '), coordinates_json, F.lit("}")))


def rings_from_geojson(text: Column) -> Column:
    """All rings of a (multi)polygon as ARRAY<ARRAY<STRUCT<x,y>>>; NULL when the text is not one."""
    kind = F.get_json_object(text, "$.type")
    coordinates = F.get_json_object(text, "$.coordinates")
    single = F.from_json(coordinates, "array<array<array<double>>>")
    multi = F.flatten(F.from_json(coordinates, "array<array<array<array<double>>>>"))
    rings = F.when(kind == "Polygon", single).when(kind == "MultiPolygon", multi)
    point = lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))
    return F.transform(rings, lambda r: F.transform(r, point))


def geometry_status(text: Column) -> Column:
    """ok, no geometry or not a polygon, per row."""
    kind = F.get_json_object(text, "$.type")
    points = F.size(rings_from_geojson(text))
    return (F.when(kind.isNull() | F.get_json_object(text, "$.coordinates").isNull(), "no geometry")
            .when(~kind.isin("Polygon", "MultiPolygon"), "not a polygon")
            .when(points > 0, "ok").otherwise("no geometry"))


def wkt(kind: Column, coordinates_json: Column) -> Column:
    """GeoJSON coordinates as well-known text, by rewriting the bracket text."""
    flat = F.regexp_replace(coordinates_json, r"\s+", "")
    pairs = F.regexp_replace(flat, r"\[(-?[0-9.eE+-]+),(-?[0-9.eE+-]+)\]", "$1 $2")
    return F.concat(F.upper(kind), F.lit(" "), F.translate(F.replace(pairs, F.lit(","), F.lit(", ")), "[]", "()"))


def box_rings(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """A closed box as one ring."""
    corner = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(F.array(corner(x0, y0), corner(x1, y0), corner(x1, y1), corner(x0, y1), corner(x0, y0)))
