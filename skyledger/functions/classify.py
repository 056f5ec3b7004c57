"""Scalar classifiers and derived columns.

Every function returns a ``Column`` built from built-in expressions, so the
whole chain stays inside whole-stage codegen and Catalyst can fold constants
and prune.  Rules are "first match wins", as in a ``CASE`` expression; null
inputs fall through to the ``otherwise`` branch exactly as SQL ``CASE`` does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# ---------------------------------------------------------------------------
# Fixed values (thresholds and labels that define the published tables).
# ---------------------------------------------------------------------------
LEO_MAX_APOGEE_KM = 2000          # apogee below: LEO
MEO_MIN_PERIGEE_KM = 2000         # perigee at least, apogee below 35000: MEO
MEO_MAX_APOGEE_KM = 35000
GEO_MIN_PERIGEE_KM = 35000        # perigee at least, apogee at most 36500: GEO
GEO_MAX_APOGEE_KM = 36500         # apogee at least: HEO
SEVERITY_LEVELS = [(1000, "catastrophic"), (100, "major"), (10, "minor")]
SEVERITY_DEFAULT = "insignificant"
CONGESTION_LEVELS = [(500, "critical"), (200, "high"), (50, "moderate")]
CONGESTION_DEFAULT = "low"
DECAY_RISK_LEVELS = [(200, "imminent"), (300, "high")]
DECAY_RISK_DEFAULT = "moderate"
CONSTELLATIONS = [
    ("STARLINK", "Starlink"),
    ("ONEWEB", "OneWeb"),
    ("KUIPER", "Kuiper"),
    ("IRIDIUM", "Iridium"),
    ("GLOBALSTAR", "Globalstar"),
]
REGIME_LABELS = {
    "LEO": "Low Earth Orbit",
    "MEO": "Medium Earth Orbit",
    "GEO": "Geostationary Orbit",
    "HEO": "Highly Elliptical Orbit",
}
TYPE_COLORS = {"PAYLOAD": "#22c55e", "DEBRIS": "#ef4444", "ROCKET BODY": "#eab308"}
TYPE_COLOR_DEFAULT = "#94a3b8"
TYPE_RGBA = {
    "PAYLOAD": (34, 197, 94, 200),
    "DEBRIS": (239, 68, 68, 180),
    "ROCKET BODY": (234, 179, 8, 200),
}
TYPE_RGBA_DEFAULT = (148, 163, 184, 160)
DEBRIS_TIERS = [(0.6, "red"), (0.3, "yellow")]
DEBRIS_TIER_DEFAULT = "green"
LOW_PERIGEE_KM = 300
LAUNCH_ID_PATTERN = r"^(\d{4}-\d{3})"
REFERENCE_BANDS_KM = [("LEO", 2000), ("MEO", 20200), ("GEO", 35786)]
UNKNOWN = "UNKNOWN"


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _at_least_ladder(value: Column, levels, default: str) -> Column:
    """``levels`` = [(threshold, label)] checked in order with ``>=``."""
    (t0, l0), *rest = levels
    out = F.when(value >= t0, l0)
    for t, label in rest:
        out = out.when(value >= t, label)
    return out.otherwise(default)


def _below_ladder(value: Column, levels, default: str) -> Column:
    """``levels`` = [(threshold, label)] checked in order with ``<``."""
    (t0, l0), *rest = levels
    out = F.when(value < t0, l0)
    for t, label in rest:
        out = out.when(value < t, label)
    return out.otherwise(default)


# F1 -------------------------------------------------------------------------
def orbital_regime(apogee: ColumnOrName = "apogee_km",
                   perigee: ColumnOrName = "perigee_km") -> Column:
    """LEO / MEO / GEO / HEO / UNKNOWN from apogee and perigee (km).

    The rule leaves holes on purpose (e.g. apogee 2000, perigee 300 is
    UNKNOWN) - they are part of the published table.
    """
    a, p = _c(apogee), _c(perigee)
    return (F.when(a < LEO_MAX_APOGEE_KM, "LEO")
            .when((p >= MEO_MIN_PERIGEE_KM) & (a < MEO_MAX_APOGEE_KM), "MEO")
            .when((p >= GEO_MIN_PERIGEE_KM) & (a <= GEO_MAX_APOGEE_KM), "GEO")
            .when(a >= GEO_MAX_APOGEE_KM, "HEO")
            .otherwise(UNKNOWN))


# F2 -------------------------------------------------------------------------
def object_category(object_type: ColumnOrName = "object_type",
                    decay_date: ColumnOrName = "decay_date") -> Column:
    t, d = _c(object_type), _c(decay_date)
    return (F.when((t == "PAYLOAD") & d.isNull(), "active_payload")
            .when((t == "PAYLOAD") & d.isNotNull(), "defunct_payload")
            .when(t == "ROCKET BODY", "rocket_body")
            .when(t == "DEBRIS", "debris")
            .otherwise("unknown"))


# F3 / F4 ----------------------------------------------------------------------
def is_debris(object_type: ColumnOrName = "object_type") -> Column:
    """Three-valued: a null type gives null."""
    return _c(object_type) == "DEBRIS"


def is_active(object_type: ColumnOrName = "object_type",
              decay_date: ColumnOrName = "decay_date") -> Column:
    """Payload that has not decayed (SQL three-valued ``AND``)."""
    return (_c(object_type) == "PAYLOAD") & _c(decay_date).isNull()


# F5 -------------------------------------------------------------------------
def launch_id(intl_designator: ColumnOrName = "OBJECT_ID") -> Column:
    """``YYYY-NNN`` launch prefix; '' when it does not match, null stays null."""
    return F.regexp_extract(_c(intl_designator), LAUNCH_ID_PATTERN, 1)


# F6, F8, F10 ------------------------------------------------------------------
def severity(debris_count: ColumnOrName = "debris_count") -> Column:
    return _at_least_ladder(_c(debris_count), SEVERITY_LEVELS, SEVERITY_DEFAULT)


def congestion_level(total_objects: ColumnOrName = "total_objects") -> Column:
    return _at_least_ladder(_c(total_objects), CONGESTION_LEVELS, CONGESTION_DEFAULT)


def decay_risk(perigee: ColumnOrName = "perigee_km") -> Column:
    return _below_ladder(_c(perigee), DECAY_RISK_LEVELS, DECAY_RISK_DEFAULT)


# F7 -------------------------------------------------------------------------
def band(value: ColumnOrName, width: int) -> Column:
    """``floor(value / width) * width`` as int (true division; negatives floor down)."""
    return (F.floor(_c(value) / F.lit(width)) * F.lit(width)).cast("int")


# F9 -------------------------------------------------------------------------
def constellation(name: ColumnOrName = "object_name") -> Column:
    """Constellation from the upper-cased name; null when none matches."""
    up = F.upper(_c(name))
    (k0, l0), *rest = CONSTELLATIONS
    out = F.when(up.contains(k0), l0)
    for key, label in rest:
        out = out.when(up.contains(key), label)
    return out.otherwise(F.lit(None).cast("string"))


# F12 ------------------------------------------------------------------------
def lenient(c: ColumnOrName, to: str) -> Column:
    """Feed-value cast: an unparsable string becomes null (ANSI stays on)."""
    return _c(c).try_cast(to)


# F13 ------------------------------------------------------------------------
def regime_label(regime: ColumnOrName = "orbital_regime") -> Column:
    r = _c(regime)
    items = list(REGIME_LABELS.items())
    out = F.when(r == items[0][0], items[0][1])
    for k, v in items[1:]:
        out = out.when(r == k, v)
    return out.otherwise(r)


# F23 ------------------------------------------------------------------------
def type_key(object_type: ColumnOrName = "object_type") -> Column:
    """Upper-cased type; null or empty becomes ``UNKNOWN``."""
    return F.coalesce(F.nullif(F.upper(_c(object_type)), F.lit("")), F.lit(UNKNOWN))


# F14 ------------------------------------------------------------------------
def type_color(object_type: ColumnOrName = "object_type") -> Column:
    t = F.upper(_c(object_type))
    items = list(TYPE_COLORS.items())
    out = F.when(t == items[0][0], items[0][1])
    for k, v in items[1:]:
        out = out.when(t == k, v)
    return out.otherwise(TYPE_COLOR_DEFAULT)


def type_rgba(object_type: ColumnOrName = "object_type") -> Column:
    """Point colour as ``array<int>`` (r, g, b, alpha)."""
    t = F.upper(_c(object_type))

    def arr(v):
        return F.array(*[F.lit(x) for x in v])

    items = list(TYPE_RGBA.items())
    out = F.when(t == items[0][0], arr(items[0][1]))
    for k, v in items[1:]:
        out = out.when(t == k, arr(v))
    return out.otherwise(arr(TYPE_RGBA_DEFAULT))


# F15 / F16 --------------------------------------------------------------------
def thousands(n: ColumnOrName) -> Column:
    """``1234567`` -> ``'1,234,567'``."""
    return F.format_number(_c(n), 0)


def percent(ratio: ColumnOrName, digits: int = 1) -> Column:
    """``0.1234`` -> ``'12.3%'``, HALF_UP on the decimal value.

    Rounding is done on a decimal, so ``0.1235`` gives ``'12.4%'`` whatever
    the binary expansion of ``12.35`` is.
    """
    scaled = _c(ratio).cast("decimal(30,10)") * F.lit(100)
    return F.when(scaled.isNotNull(), F.format_string(
        f"%.{digits}f%%", F.round(scaled, digits).cast("double")))


# F17 / F18 ----------------------------------------------------------------------
def debris_tier(ratio: ColumnOrName = "debris_ratio") -> Column:
    r = _c(ratio)
    (t0, l0), *rest = DEBRIS_TIERS
    out = F.when(r > t0, l0)
    for t, label in rest:
        out = out.when(r > t, label)
    return out.otherwise(DEBRIS_TIER_DEFAULT)


def low_perigee(perigee: ColumnOrName = "perigee_km") -> Column:
    return _c(perigee) < LOW_PERIGEE_KM


# F19 / F20 / F22 -----------------------------------------------------------------
def round_half_up(x: ColumnOrName, digits: int = 0) -> Column:
    return F.round(_c(x), digits)


def iso_date_part(ts: ColumnOrName) -> Column:
    """First ten characters of an ISO timestamp string (``YYYY-MM-DD``)."""
    return F.substring(_c(ts).cast("string"), 1, 10)


def km_to_m(x: ColumnOrName) -> Column:
    return _c(x) * 1000
