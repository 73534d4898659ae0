"""Digests of whole tables, whatever their order and partitions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Hexadecimal digits of a line's digest that one sum takes, so that sums over 10**19 lines stay exact.
_DIGITS = 15


def of_lines(line: Column) -> Column:
    """An aggregate: the digest of a multiset of lines.

    Each line's SHA-256 is cut into four numbers; their sums and the number of lines, hashed again, tell the multiset.  Sums are
    made in every task, so no task ever holds the lines.
    """
    digest = F.sha2(line, 256)
    sums = [F.coalesce(F.sum(F.conv(F.substring(digest, 1 + _DIGITS * k, _DIGITS), 16, 10).cast("decimal(19,0)").cast("decimal(38,0)")), F.lit(0)) for k in range(4)]
    return F.sha2(F.concat_ws("|", F.count(line).cast("string"), *[s.cast("decimal(38,0)").cast("string") for s in sums]), 256)


#: The same in DuckDB's SQL, of a column ``line``.
SQL = "sha256(concat_ws('|', CAST(count(line) AS VARCHAR), " + ", ".join(f"CAST(CAST(coalesce(sum(CAST('0x' || substr(sha256(line), {1 + _DIGITS * k}, {_DIGITS}) AS HUGEINT)), 0) AS HUGEINT) AS VARCHAR)" for k in range(4)) + "))"
