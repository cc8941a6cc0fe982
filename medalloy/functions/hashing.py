"""Row hashes for change detection."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_hash(cols: list[str], *, null_safe: bool = True, sep: str = "|") -> Column:
    """md5 over the listed columns.

    ``null_safe=False`` is ``md5(concat_ws(sep, cols))``, which skips nulls, so
    ('a', null, 'b') and ('a', 'b', null) collide. The default length-prefixes
    every value and writes a marker for null, so shifted nulls hash apart.
    """
    if not null_safe:
        return F.md5(F.concat_ws(sep, *[F.col(c).cast("string") for c in cols]))
    parts = []
    for c in cols:
        s = F.col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(s).cast("string"), F.lit(":"), s), F.lit("~")))
    return F.md5(F.concat_ws(sep, *parts))
