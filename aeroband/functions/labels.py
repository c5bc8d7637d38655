"""Pollutant labels."""

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from aeroband.functions import sql_text
from aeroband.schemas import LABEL_RULES


def contains_any(label: Column, texts) -> Column:
    """True if the label contains one of the texts, letter case included; false if there are none."""
    return reduce(or_, [label.contains(text) for text in texts], F.lit(False))


def standardise(label: str, rules=LABEL_RULES, default: str | None = None, lowered: str | None = None) -> Column:
    """Standard name of a raw label: that of the first rule matching the lower-case label.

    Labels no rule knows become ``default``, or the trimmed upper-case label. The rules are taken as they are:
    they do not know the full names of sulphur dioxide and carbon monoxide, which therefore come out as
    unknown labels and fail the accepted-values check. ``lowered`` names a column that already holds the
    lower-case label, so that it is not computed once per rule.
    """
    lowered = lowered or f"lower({label})"
    otherwise = default or f"upper(trim({label}))"
    cases = []
    for name, wanted, unwanted in rules:
        matches = " or ".join(f"{lowered} like {sql_text(p)}" for p in wanted)
        excludes = "".join(f" and {lowered} not like {sql_text(p)}" for p in unwanted)
        cases.append(f"when ({matches}){excludes} then {sql_text(name)}")
    return F.expr(f"case {' '.join(cases)} else {otherwise} end" if cases else otherwise)
