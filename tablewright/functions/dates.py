"""Dates out of dirty text, and labels made from timestamps.

Functions here take a SQL expression as text and return one.
"""

from __future__ import annotations

# Accepted spellings, tried in this order; the shape keeps parsing (and its
# exceptions) away from text that cannot match. Dates that start with a day or month number are month first
# unless that number is no month.
MONTHS = "(Jan(uary)?|Feb(ruary)?|Mar(ch)?|Apr(il)?|May|June?|July?|Aug(ust)?|Sept?(ember)?|Oct(ober)?|Nov(ember)?|Dec(ember)?)"
DATE_SHAPES = (
    ("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$", "y-M-d"),
    ("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}[T ][0-9]{1,2}:[0-9]{2}.*$", "y-M-d"),
    ("^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}$", "y/M/d"),
    ("^[0-9]{4}[.][0-9]{1,2}[.][0-9]{1,2}$", "y.M.d"),
    ("^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "M/d/y"),
    ("^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$", "M-d-y"),
    (f"^{MONTHS}[.]? [0-9]{{1,2}},? [0-9]{{4}}$", "MMM d y"),
    (f"^[0-9]{{1,2}} {MONTHS}[.]?,? [0-9]{{4}}$", "d MMM y"),
    ("^[0-9]{1,2}[A-Z]{3}[0-9]{4}$", "dMMMy"),
)
DAY_FIRST = {"M/d/y": "d/M/y", "M-d-y": "d-M-y"}


def _try_date(x: str, fmt: str) -> str:
    return f"cast(try_to_timestamp({x}, '{fmt}') AS date)"


def parse_date(x: str, guess: bool = True) -> str:
    """Date, or null if no accepted spelling fits. Without ``guess`` also null where day and month could be swapped."""
    text = f"trim({x})"
    spelled = {
        # the parser wants 'Jun', also where the data has 'JUN' or 'June,'
        "dMMMy": f"replace(initcap(regexp_replace({text}, '([A-Z]{{3}})', ' $1 ')), ' ', '')",
        "MMM d y": f"regexp_replace({text}, '^([A-Z][a-z][a-z])[a-z]*[.]? ([0-9]+),? ', '$1 $2 ')",
        "d MMM y": f"regexp_replace({text}, ' ([A-Z][a-z][a-z])[a-z]*[.]?,? ', ' $1 ')",
        "y-M-d": f"substring_index(substring_index({text}, 'T', 1), ' ', 1)",
    }
    cases = []
    for shape, fmt in DATE_SHAPES:
        value = _try_date(spelled.get(fmt, text), fmt)
        if fmt in DAY_FIRST:
            other = _try_date(text, DAY_FIRST[fmt])
            value = f"coalesce({value}, {other})" if guess else f"CASE WHEN coalesce({value} = {other}, true) THEN coalesce({value}, {other}) END"
        cases.append(f"WHEN {text} RLIKE '{shape}' THEN {value}")
    return f"CASE {' '.join(cases)} END"


def to_iso_date(x: str) -> str:
    """ISO text, '' if missing or unparseable."""
    return f"coalesce(date_format({parse_date(x)}, 'yyyy-MM-dd'), '')"


def calendar_date(x: str) -> str:
    """The date of a year-month-day text that names a real day, else null."""
    shape, fmt = DATE_SHAPES[0]
    return f"CASE WHEN trim({x}) RLIKE '{shape}' THEN {_try_date(f'trim({x})', fmt)} END"


def is_calendar_date(x: str) -> str:
    return f"(({calendar_date(x)}) IS NOT NULL)"


def parse_timestamp(x: str, fmt: str = "yyyy-MM-dd''T''HH:mm:ss''Z''") -> str:
    return f"try_to_timestamp({x}, '{fmt}')"


def ts_label(x: str) -> str:
    """A timestamp as used in run, branch and tag names."""
    return f"date_format({x}, '_yyyy-MM-dd_HH-mm-ss')"


def month_of(x: str) -> str:
    return f"date_format({x}, 'yyyy-MM')"
