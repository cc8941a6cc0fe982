"""Text normalisation helpers (regexp chains, no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from medalloy.functions.casts import strict_double

# Fixed value: terminal colour escape sequences, ESC '[' digits/semicolons 'm'.
ANSI_PATTERN = "\u001b\\[[0-9;]*m"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def normalise_name(col) -> Column:
    """lower → 'st.'→'saint', 'ste.'→'sainte' (wherever they stand) → drop non-alphanumerics → squeeze blanks."""
    s = F.lower(_c(col))
    s = F.replace(F.replace(s, F.lit("st."), F.lit("saint")), F.lit("ste."), F.lit("sainte"))
    s = F.regexp_replace(s, r"[^a-z0-9 ]", " ")
    s = F.regexp_replace(s, r" +", " ")
    return F.trim(s)


def strip_ansi(col) -> Column:
    return F.trim(F.regexp_replace(_c(col), ANSI_PATTERN, ""))


def sentinel_number(col) -> Column:
    """Workbook sentinels: ``'-'`` → null, ``'( 2.56)'`` → 2.56 (parentheses are padding, not sign)."""
    s = F.trim(_c(col))
    s = F.when(s == F.lit("-"), F.lit(None).cast("string")).otherwise(
        F.regexp_replace(s, r"^\(\s*(.*?)\s*\)$", "$1")
    )
    return strict_double(s)


# Price-index geography level → key kind.
LEVEL_KINDS = {"MSA": "cbsa", "State": "state", "USA or Census Division": "division", "Puerto Rico": "territory"}


def geo_key(level, place_id) -> Column:
    """Tagged-union geography key: struct(kind, id); unknown level → NULL kind."""
    lv = _c(level)
    kind = F.lit(None).cast("string")
    for k, v in reversed(list(LEVEL_KINDS.items())):
        kind = F.when(lv == F.lit(k), F.lit(v)).otherwise(kind)
    return F.struct(kind.alias("kind"), F.trim(_c(place_id)).alias("id"))


def title_parts(title: Column) -> dict[str, Column]:
    """Area title ``city-city, ST-ST`` → ``cities``, ``states`` (arrays) and ``primary_state``.

    The last comma parts cities from states; blank parts are dropped. A title without a comma has
    no states and an empty primary state; a NULL title gives NULLs.
    """
    def parts(blob: Column) -> Column:
        return F.filter(F.transform(F.split(blob, "-"), lambda p: F.trim(p)), lambda p: p != "")

    states = parts(F.regexp_extract(title, r"(?s)^.*,(.*)$", 1))
    return {"cities": parts(F.regexp_replace(title, r"(?s),[^,]*$", "")), "states": states,
            "primary_state": F.when(title.isNotNull(), F.coalesce(F.get(states, 0), F.lit("")))}


def zero_pad(code: Column, width: int) -> Column:
    """Code text with leading zeros up to ``width``; longer codes stay whole."""
    s = code.cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def county_key(state: Column, county: Column) -> Column:
    """Two-digit state and three-digit county code in one key."""
    return F.concat(zero_pad(state, 2), zero_pad(county, 3))
