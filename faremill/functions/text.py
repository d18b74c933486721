"""Text defaults and captures."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what a missing zone attribute becomes.
UNKNOWN = "Unknown"

# What stands before the month in the name of a delivered file, or of a
# folder of part files, and what a month looks like.
MONTH_PREFIX = "yellow_tripdata_"
MONTH_FORM = r"^\d{4}-\d{2}$"
MONTH_IN_PATH = MONTH_PREFIX + r"(\d{4}-\d{2})"
MONTH_FOLDER = rf"^(.*?{MONTH_IN_PATH}[^/]*)/"
MONTH_LENGTH = 7


def known(text: Column) -> Column:
    """Null and empty text become `Unknown`; literal text such as N/A stays."""
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(UNKNOWN))


def capture(text: Column, pattern: str, group: int = 1) -> Column:
    """A regex group, or null where the pattern does not match."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def month_of(name: Column, path: Column) -> Column:
    """The month a file was delivered under, from its name or that of its folder; else null.

    Evaluated for every row of a scan, so the usual case, a flat file, is cut out by
    position, and only part files match a pattern. Listings check the form.
    """
    return (
        F.when(F.startswith(name, F.lit(MONTH_PREFIX)), F.substring(name, len(MONTH_PREFIX) + 1, MONTH_LENGTH))
        .when(F.contains(path, F.lit(MONTH_PREFIX)), F.regexp_extract(path, MONTH_IN_PATH, 1))
    )


def delivery_of(name: Column, path: Column) -> Column:
    """The path of what a month was delivered as: the file, or the folder that the month is named on."""
    return F.coalesce(F.when(~F.startswith(name, F.lit(MONTH_PREFIX)), capture(path, MONTH_FOLDER)), path)
