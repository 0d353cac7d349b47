"""Numbers out of dirty text. Functions here take a SQL expression as text and return one."""

from __future__ import annotations


# A cast alone would also read the number literals of programming languages, such as 1d and 0x1p3.
NUMBER = "^[+-]?(([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?|[nN][aA][nN]|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$"


def to_number(x: str) -> str:
    """Double, or null where the text is no number."""
    return f"CASE WHEN trim({x}) RLIKE '{NUMBER}' THEN try_cast({x} AS double) END"


def parse_amount(x: str) -> str:
    """Money as printed: currency sign and thousands separators are dropped."""
    return to_number(f"trim(translate(cast({x} AS string), '$,', ''))")


def real(x: str) -> str:
    """The value, or null for NaN: Spark orders NaN above all numbers, most languages compare it false."""
    return f"nullif({x}, double('NaN'))"


def differs(a: str, b: str, tolerance: float = 0.01) -> str:
    return f"abs({a} - {b}) > {tolerance}D"
