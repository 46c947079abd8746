"""Standard spellings of country, plan and billing frequency."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from growthlake.functions.semantics import when_in

# fixed values: lower-case source spellings per standard code
COUNTRY_SPELLINGS = {
    "US": ["us", "usa", "united states", "united states of america"],
    "CA": ["ca", "can", "canada"],
    "GB": ["gb", "uk", "united kingdom"],
}
PLAN_SPELLINGS = {"enterprise": ["enterprise", "ent"]}
FREQUENCY_SPELLINGS = {"monthly": ["monthly", "month"], "annual": ["annual", "year"]}


def standard_country(c) -> Column:
    """ISO code of a known spelling; anything else stays as it is."""
    value = F.col(c) if isinstance(c, str) else c
    return when_in(F.lower(value), COUNTRY_SPELLINGS, value)


def standard_plan(c) -> Column:
    """Plan code; free, trial and pro need no more than lower case."""
    value = F.lower(F.col(c) if isinstance(c, str) else c)
    return when_in(value, PLAN_SPELLINGS, value)


def standard_frequency(c) -> Column:
    value = F.lower(F.col(c) if isinstance(c, str) else c)
    return when_in(value, FREQUENCY_SPELLINGS, value)
