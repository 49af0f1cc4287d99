"""Text of the report lines. A NULL part makes the whole line NULL."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wording of the reports.
SONG_LINE = ('"', '" by ', " played ", " times.")
ARTIST_LINE = ('"', '" was played ', " times.")
RATIO_LABEL = "Ratio: "
FREE_LABEL = "Free users: "
PAID_LABEL = "Paid users: "


def song_line(title: str, name: str, plays: str) -> Column:
    return _fill(SONG_LINE, title, name, plays)


def artist_line(name: str, plays: str) -> Column:
    return _fill(ARTIST_LINE, name, plays)


def labelled(label: str, value: str) -> Column:
    return F.concat(F.lit(label), F.col(value).cast("string"))


def ratio(numerator: str, denominator: str) -> Column:
    """`n/d` and `d/d` as text around a colon; NULL when the denominator is zero."""
    return F.concat(
        F.try_divide(numerator, denominator).cast("string"),
        F.lit(":"),
        F.try_divide(denominator, denominator).cast("string"),
    )


def _fill(pieces: tuple[str, ...], *columns: str) -> Column:
    parts = [F.lit(pieces[0])]
    for column, piece in zip(columns, pieces[1:]):
        parts += [F.col(column).cast("string"), F.lit(piece)]
    return F.concat(*parts)
