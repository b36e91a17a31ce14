"""Date normalisation: first listed form that parses wins; missing or unparseable -> 'NaT'.

``try_to_timestamp`` reports a failed parse through an exception inside the JVM, which is
costly when most tries fail (blank cells, values of a later form). Each form is therefore
guarded by a cheap regular expression that accepts a superset of what the form can parse
(ASCII digits, no surrounding spaces, as the strict parser requires), and blanks are never
parsed. The guards change no result, only which parses are attempted.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from driftsweep.schema import DATE_FORMATS, NAT

_D = "[0-9]+"
_AMPM = "[AaPp][Mm]"
# A superset pattern per date form (same order as DATE_FORMATS).
_GUARDS = {
    "yyyy-MM-dd HH:mm:ss": f"^{_D}-{_D}-{_D} {_D}:{_D}:{_D}$",
    "yyyy-MM-dd": f"^{_D}-{_D}-{_D}$",
    "M/d/yyyy": f"^{_D}/{_D}/{_D}$",
    "MMM d, yyyy": f"^[A-Za-z]+ {_D}, {_D}$",
    "yyyyMMdd": f"^{_D}$",
    "yyyy-MM-dd HH:mm:ss.SSSSSS": f"^{_D}-{_D}-{_D} {_D}:{_D}:{_D}\\.{_D}$",
    "yyyy-MM-dd'T'HH:mm:ss": f"^{_D}-{_D}-{_D}T{_D}:{_D}:{_D}$",
    "M/d/yyyy H:mm:ss": f"^{_D}/{_D}/{_D} {_D}:{_D}:{_D}$",
    "M/d/yyyy H:mm": f"^{_D}/{_D}/{_D} {_D}:{_D}$",
    "M/d/yyyy h:mm:ss a": f"^{_D}/{_D}/{_D} {_D}:{_D}:{_D} {_AMPM}$",
    "M/d/yyyy h:mm a": f"^{_D}/{_D}/{_D} {_D}:{_D} {_AMPM}$",
}


def _try(c: Column, fmt: str) -> Column:
    guard = _GUARDS.get(fmt)
    parsed = F.try_to_timestamp(c, F.lit(fmt))
    return parsed if guard is None else F.when(c.rlike(guard), parsed)


_MONTH, _DAY = "(?:0?[1-9]|1[0-2])", "(?:0?[1-9]|[12][0-9]|3[01])"
_SLASHES = f"^{_D}/{_D}/{_D}( .*)?$"
_MONTH_FIRST = f"^{_MONTH}/{_DAY}/{_D}( .*)?$"
_DAY_FIRST = f"^{_DAY}/{_MONTH}/{_D}( .*)?$"


def slash_votes(c: Column) -> dict[str, Column]:
    """A value's votes on the order of its column's slash dates: it is one, it can be month first, it can be day first.

    The votes of a column are sums, so they merge in any order (see ``day_first``)."""
    slash = F.contains(c, F.lit("/"))    # few values reach the patterns
    return {"n_slash": slash & c.rlike(_SLASHES), "n_month_first": slash & c.rlike(_MONTH_FIRST),
            "n_day_first": slash & c.rlike(_DAY_FIRST)}


def day_first(n_slash: Column, n_month_first: Column, n_day_first: Column) -> Column:
    """A column is read day first if that explains all its slash dates and month first does not."""
    return (n_slash > 0) & (n_day_first == n_slash) & (n_month_first < n_slash)


def month_first_text(c: Column) -> Column:
    """A day-first slash date as month-first text; other texts as they are."""
    return F.when(c.rlike(_DAY_FIRST), F.regexp_replace(c, f"^({_D})/({_D})/", "$2/$1/")).otherwise(c)


def parse_date(c: Column) -> Column:
    """Timestamp of the first format in DATE_FORMATS that parses ``c`` (NULL if none)."""
    return F.when(c.isNotNull() & (F.length(c) > 0), F.coalesce(*[_try(c, fmt) for fmt in DATE_FORMATS]))


_PLAIN = "^[1-9][0-9]{3}-[0-9]{2}-[0-9]{2}\\z"    # $ would let a line break follow


def normalise_date(c: Column) -> Column:
    """YYYY-MM-DD text with the time dropped; NULL, blank and junk become 'NaT'.

    A text that is a date in this form already stays as it is, neither parsed nor formatted."""
    plain = c.rlike(_PLAIN) & c.try_cast("date").isNotNull()
    return F.when(plain, c).otherwise(F.coalesce(F.date_format(parse_date(c), "yyyy-MM-dd"), F.lit(NAT)))
