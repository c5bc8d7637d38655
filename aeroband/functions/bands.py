"""The banded air-quality index."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from aeroband.functions import sql_text
from aeroband.schemas import BAND_COLOURS, BAND_LABELS, UNKNOWN_BAND, UNKNOWN_COLOUR


def band_index(value: str, uppers) -> Column:
    """1-based number of the first band whose inclusive upper bound is not exceeded, one more than the number
    of bounds beyond them all, null for null."""
    bands = " ".join(f"when {value} <= {float(upper)}D then {band}" for band, upper in enumerate(uppers, start=1))
    return F.expr(f"case when {value} is null then null {bands} else {len(uppers) + 1} end")


def worst_of(*indices: str) -> Column:
    """The highest index, an absent one counting as 0; so 0 if all are absent."""
    return F.expr(f"greatest({', '.join(f'coalesce({index}, 0)' for index in indices)})")


def index_label(index: str, labels=BAND_LABELS, unknown=UNKNOWN_BAND) -> Column:
    """The word for an index value."""
    words = " ".join(f"when {value} then {sql_text(word)}" for value, word in labels.items())
    return F.expr(f"case {index} {words} else {sql_text(unknown)} end")


def band_colour(mean_index: str, colours=BAND_COLOURS, unknown=UNKNOWN_COLOUR) -> Column:
    """Map colour of a mean index: truncated, then clamped to the known bands.

    A mean that is null, 0 or not a number counts as band 1. A plain cast of NaN to integer raises under ANSI
    rules; try_cast gives null.
    """
    lowest, highest = min(colours), max(colours)
    band = f"least({highest}, greatest({lowest}, coalesce(try_cast({mean_index} as int), {lowest})))"
    pairs = ", ".join(f"{value}, {sql_text(colour)}" for value, colour in colours.items())
    return F.expr(f"coalesce(try_element_at(map({pairs}), {band}), {sql_text(unknown)})")
