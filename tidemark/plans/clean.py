"""Entity cleaners.

Every rule is optional: it applies when its column is there. A cleaner collects one expression
per output column and projects once, so the plan is a single scan and projection.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import age_years, duration_minutes, parse_ts, stamp
from ..functions.hashing import natural_id
from ..functions.numeric import clamp_min, fixed
from ..functions.text import (
    NOT_APPLICABLE,
    NOT_PROVIDED,
    UNKNOWN,
    UNKNOWN_CATEGORY,
    blank_to,
    collapse_ws,
    norm_phone,
    norm_zip,
    printable,
    title,
    valid_uuid,
)
from ..operators.project import columns_of_type, standardize_names

# Defaults, formats and rates of the entities.
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"
NAME_DEFAULTS = {"prefix": NOT_PROVIDED, "first": NOT_PROVIDED, "last": NOT_PROVIDED, "maiden": NOT_APPLICABLE,
                 "suffix": NOT_APPLICABLE}
CATEGORIES = ["marital", "race", "ethnicity", "gender"]
PLACES = ["address", "city", "state", "county", "birthplace"]
PAYER_DEFAULTS = {"ADDRESS": NOT_PROVIDED, "CITY": UNKNOWN, "STATE_HEADQUARTERED": UNKNOWN}
PROCEDURE_DEFAULTS = {"reasoncode": 0, "reasondescription": "Unknown Reason"}
ENCOUNTER_DEFAULTS = PROCEDURE_DEFAULTS | {"payer_coverage": 0, "base_encounter_cost": 0, "total_claim_cost": 0}
NO_ORGANIZATION = "Unknown Organization"
RATE_COLUMNS, RATE_FACTOR = ["AverageRate", "EndOfDayRate"], 75


def _trimmed(df):
    """Current expression of every column: text trimmed, the rest as is."""
    text = set(columns_of_type(df, T.StringType))
    return {c: F.trim(F.col(c)) if c in text else F.col(c) for c in df.columns}


def _zip(df, exprs, name):
    if name in exprs:
        numeric = isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))
        exprs[name] = norm_zip(exprs[name], numeric)


def _project(df, exprs):
    return df.select(*[e.alias(name) for name, e in exprs.items()])


def _place(c):
    return title(F.trim(collapse_ws(c)))


def clean_patients(df, asof, now) -> DataFrame:
    """Names, categories, dates, age at ``asof``, places, coordinates, id check, load stamp."""
    df = standardize_names(df)
    text = columns_of_type(df, T.StringType)
    e = _trimmed(df)
    _zip(df, e, "zip")
    for c, default in NAME_DEFAULTS.items():
        if c in e:
            e[c] = blank_to(title(e[c]), default)
    for c in CATEGORIES:
        if c in e:
            e[c] = blank_to(F.upper(e[c]), UNKNOWN_CATEGORY)
    for c in PLACES:
        if c in e:
            e[c] = blank_to(_place(e[c]), UNKNOWN)
    for c in text:
        e[c] = printable(e[c])
    dates = [c for c in ("birthdate", "deathdate") if c in e]
    for c in dates:
        e[c] = parse_ts(e[c], "yyyy-MM-dd") if c in text else e[c].cast("timestamp_ntz")
    for c in ("lat", "lon"):
        if c in e:
            e[c] = F.coalesce(e[c], F.lit(0.0))
    if "birthdate" in e:
        e["age"] = age_years(e["birthdate"], asof)
    if "id" in e:
        e["valid_uuid"] = valid_uuid(F.trim(F.col("id")))
    e["Last_Modified"] = stamp(now)
    return _project(df, e)


def clean_payers(df) -> DataFrame:
    """Upper-case names, postal codes, phone digits, defaults, collapsed names, id check."""
    df = standardize_names(df, "upper")
    e = _trimmed(df)
    _zip(df, e, "ZIP")
    if "PHONE" in e:
        e["PHONE"] = norm_phone(e["PHONE"])
    for c, default in PAYER_DEFAULTS.items():
        if c in e:
            e[c] = blank_to(e[c], default)
    for c in ("NAME", "CITY"):
        if c in e:
            e[c] = collapse_ws(F.trim(e[c]))
    if "ID" in e:
        e["VALID_UUID"] = valid_uuid(F.trim(F.col("ID")))
    return _project(df, e)


def _timed_entity(df, defaults):
    """Shared part of procedures and encounters: times, defaults, descriptions, duration."""
    e = {c: F.col(c) for c in df.columns}
    for c in ("start", "stop"):
        if c in e:
            e[c] = parse_ts(e[c], ISO_SECONDS)
    for c, default in defaults.items():
        if c in e:
            e[c] = F.coalesce(e[c], F.lit(default).cast(df.schema[c].dataType))
    for c in ("description", "reasondescription"):
        if c in e:
            e[c] = printable(F.trim(title(e[c])))
    if "start" in e and "stop" in e:
        e["duration_minutes"] = duration_minutes(e["start"], e["stop"])
    return e


def clean_procedures(df) -> DataFrame:
    """Times, defaults, descriptions, non-negative cost, minutes, and an id stable across runs."""
    df = standardize_names(df)
    raw = list(df.columns)
    e = _timed_entity(df, PROCEDURE_DEFAULTS)
    if "base_cost" in e:
        e["base_cost"] = clamp_min(e["base_cost"], 0)
    e["Procedure_Id"] = natural_id(raw)
    return _project(df, e)


def clean_encounters(df) -> DataFrame:
    df = standardize_names(df)
    return _project(df, _timed_entity(df, ENCOUNTER_DEFAULTS))


def clean_organizations(df) -> DataFrame:
    df = standardize_names(df)
    e = _trimmed(df)
    _zip(df, e, "zip")
    if "name" in e:
        e["name"] = blank_to(_place(e["name"]), NO_ORGANIZATION)
    return _project(df, e)


def clean_generic(df, rate_columns=RATE_COLUMNS, factor=RATE_FACTOR) -> DataFrame:
    """Type-driven cleaning of a retail extract.

    Text is upper-cased, decimals and doubles become two-decimal text, rate columns are converted
    and floored, product numbers are prefixed by the name, names get a three-letter region code.
    """
    e = {}
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in rate_columns:
            e[f.name] = F.floor(c.cast("double") * factor)
        elif isinstance(f.dataType, T.StringType):
            e[f.name] = F.upper(c)
        elif isinstance(f.dataType, (T.DecimalType, T.DoubleType)):
            e[f.name] = fixed(c, 2)
        else:
            e[f.name] = c
    if "ProductNumber" in e and "Name" in e:
        e["ProductNumber"] = F.concat(e["Name"], F.substring(e["ProductNumber"], F.lit(3), F.length(e["ProductNumber"])))
    if "Name" in e:
        e["New_Region_Name"] = F.substring(e["Name"], 1, 3)
    return _project(df, e)


# Cleaners by entity file name, for ``sources.readers.run_entities``.
def registry(asof, now):
    return {"patients": lambda df: clean_patients(df, asof, now), "payers": clean_payers,
            "procedures": clean_procedures, "encounters": clean_encounters, "organizations": clean_organizations}
