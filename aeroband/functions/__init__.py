"""Column expressions, all evaluated inside the JVM.

Long CASE chains are generated as SQL text from the fixed tables: the plan is the same as with chained ``when``, and
one expression costs one call into the JVM instead of dozens. Their arguments are SQL expressions, such as a column
name.
"""


def sql_text(value: str) -> str:
    """A string as an SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
