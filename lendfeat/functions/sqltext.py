"""Quoting for Spark SQL expression text built by the library.

Wide expressions (dozens of months, hundreds of level counts) are written as
SQL text and parsed once in the JVM, instead of being assembled from many small
``Column`` calls; these helpers keep names and values safe inside that text.
"""

from __future__ import annotations


def quote(name: str) -> str:
    """A column name as a SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def literal(v) -> str:
    """A Python value as a SQL literal (numbers as is, strings quoted)."""
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
