"""Two-line element set (TLE) field extraction (E1).

Column positions follow the public fixed-width TLE layout (1-based, inclusive).
Every field is a ``substring`` + ``trim`` + lenient cast, so a malformed or
short line yields nulls instead of failing the job, and the whole parse is a
projection inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The TLE column layout, (first column, width).
LINE1_FIELDS = {
    "satnum": (3, 5), "classification": (8, 1), "intl_designator": (10, 8),
    "epoch_year": (19, 2), "epoch_day": (21, 12), "ndot": (34, 10),
    "nddot": (45, 8), "bstar": (54, 8), "ephemeris_type": (63, 1),
    "element_set_no": (65, 4), "checksum": (69, 1),
}
LINE2_FIELDS = {
    "satnum": (3, 5), "inclination": (9, 8), "ra_of_asc_node": (18, 8),
    "eccentricity": (27, 7), "arg_of_pericenter": (35, 8), "mean_anomaly": (44, 8),
    "mean_motion": (53, 11), "rev_number": (64, 5), "checksum": (69, 1),
}
TWO_DIGIT_YEAR_PIVOT = 57  # 57-99 -> 1957-1999, 00-56 -> 2000-2056


def _field(line: Column, spec) -> Column:
    start, width = spec
    return F.trim(F.substring(line, start, width))


def _implied_decimal(raw: Column) -> Column:
    """``' 12345-4'`` -> ``0.12345e-4`` (sign, 5 mantissa digits, signed exponent)."""
    s = F.trim(raw)
    mant = F.regexp_extract(s, r"^([+-]?)(\d{1,5})([+-]\d)$", 2)
    sign = F.when(F.regexp_extract(s, r"^([+-]?)(\d{1,5})([+-]\d)$", 1) == "-", -1.0).otherwise(1.0)
    exp = F.regexp_extract(s, r"^([+-]?)(\d{1,5})([+-]\d)$", 3)
    value = sign * F.concat(F.lit("0."), mant).try_cast("double") * F.pow(F.lit(10.0), exp.try_cast("double"))
    return F.when(mant != "", value)


# The first character of a five-character number from 100,000 on
# (I and O are not used), worth 10 and up.
NUMBER_LETTERS = "ABCDEFGHJKLMNPQRSTUVWXYZ"


def catalogue_number(raw: Column) -> Column:
    """Catalogue number of a trimmed field: digits, or a letter and four digits."""
    letter = F.instr(F.lit(NUMBER_LETTERS), F.substring(raw, 1, 1))
    return F.when(raw.rlike(f"^[{NUMBER_LETTERS}][0-9]{{4}}$"),
                  (letter + 9) * 10_000 + F.substring(raw, 2, 4).try_cast("int")) \
        .otherwise(raw.try_cast("int"))


def checksum(line: Column) -> Column:
    """Modulo-10 checksum of columns 1-68: digits count their value, '-' counts 1."""
    chars = F.split(F.substring(line, 1, 68), "")
    return F.aggregate(
        chars, F.lit(0),
        lambda acc, c: acc + F.when(c.rlike("^[0-9]$"), c.cast("int"))
                              .when(c == "-", 1).otherwise(0)) % 10


def parse_tle(df: DataFrame, line1: str = "tle_line1", line2: str = "tle_line2") -> DataFrame:
    """Add parsed TLE fields (prefixed ``tle_``) and checksum flags."""
    l1, l2 = F.col(line1), F.col(line2)
    yy = _field(l1, LINE1_FIELDS["epoch_year"]).try_cast("int")
    year = F.when(yy >= TWO_DIGIT_YEAR_PIVOT, yy + 1900).otherwise(yy + 2000)
    day = _field(l1, LINE1_FIELDS["epoch_day"]).try_cast("double")
    # only a day-of-year in [1, 367) is turned into a time (no overflow on junk)
    micros = F.when((day >= 1) & (day < 367),
                    F.round((day - 1) * F.lit(86_400_000_000.0)).cast("long"))
    epoch = F.timestamp_add("MICROSECOND", micros, F.make_timestamp_ntz(
        year, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)))
    ecc_digits = _field(l2, LINE2_FIELDS["eccentricity"])
    return df.select(
        "*",
        F.substring(l1, 1, 1).alias("tle_line1_no"),
        catalogue_number(_field(l1, LINE1_FIELDS["satnum"])).alias("tle_satnum"),
        _field(l1, LINE1_FIELDS["classification"]).alias("tle_classification"),
        _field(l1, LINE1_FIELDS["intl_designator"]).alias("tle_intl_designator"),
        F.when(yy.isNotNull() & (day >= 1) & (day < 367), epoch).alias("tle_epoch"),
        _field(l1, LINE1_FIELDS["ndot"]).try_cast("double").alias("tle_ndot"),
        _implied_decimal(F.substring(l1, *LINE1_FIELDS["nddot"])).alias("tle_nddot"),
        _implied_decimal(F.substring(l1, *LINE1_FIELDS["bstar"])).alias("tle_bstar"),
        _field(l1, LINE1_FIELDS["element_set_no"]).try_cast("int").alias("tle_element_set_no"),
        _field(l2, LINE2_FIELDS["inclination"]).try_cast("double").alias("tle_inclination"),
        _field(l2, LINE2_FIELDS["ra_of_asc_node"]).try_cast("double").alias("tle_ra_of_asc_node"),
        F.when(ecc_digits.rlike(r"^\d+$"), F.concat(F.lit("0."), ecc_digits).try_cast("double"))
         .alias("tle_eccentricity"),
        _field(l2, LINE2_FIELDS["arg_of_pericenter"]).try_cast("double").alias("tle_arg_of_pericenter"),
        _field(l2, LINE2_FIELDS["mean_anomaly"]).try_cast("double").alias("tle_mean_anomaly"),
        _field(l2, LINE2_FIELDS["mean_motion"]).try_cast("double").alias("tle_mean_motion"),
        _field(l2, LINE2_FIELDS["rev_number"]).try_cast("int").alias("tle_rev_number"),
        (checksum(l1) == _field(l1, LINE1_FIELDS["checksum"]).try_cast("int")).alias("tle_line1_ok"),
        (checksum(l2) == _field(l2, LINE2_FIELDS["checksum"]).try_cast("int")).alias("tle_line2_ok"),
    )


# Element columns of the object table, by parsed field.
ELEMENTS = {
    "epoch": "tle_epoch", "mean_motion": "tle_mean_motion", "eccentricity": "tle_eccentricity",
    "inclination": "tle_inclination", "ra_of_asc_node": "tle_ra_of_asc_node",
    "arg_of_pericenter": "tle_arg_of_pericenter", "mean_anomaly": "tle_mean_anomaly",
}


def elements_from_tle(df: DataFrame, line1: str = "tle_line1",
                      line2: str = "tle_line2") -> DataFrame:
    """``df`` with the orbital elements of its two lines, under the names that
    :func:`skyledger.plans.positions.position_grid` reads (they replace columns of
    the same name).  Rows whose lines fail their checksum have null elements."""
    kept = [c for c in df.columns if c not in ELEMENTS]
    parsed = parse_tle(df.select(*kept), line1, line2)
    valid = F.col("tle_line1_ok") & F.col("tle_line2_ok")
    return parsed.select(*kept, *[F.when(valid, F.col(c)).alias(n) for n, c in ELEMENTS.items()])
