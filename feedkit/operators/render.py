"""Feed text rendering.

Every feed ends with ``REPORT_ORDER int, IS_HEADER int, REPORT_TEXT string``:
header rows are numbered 1..n with IS_HEADER 1, data rows share order 999
with IS_HEADER 0. Column order inside a line is given by the caller.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from feedkit.functions.text import q
from feedkit.functions.text import s as sq

DATA_ORDER = 999
TAIL = ("REPORT_ORDER", "IS_HEADER", "REPORT_TEXT")


@dataclass(frozen=True)
class Lit:
    """A literal text field inside a rendered line."""

    text: str


def _c(x: str | Column) -> Column:
    return F.col(f"`{x}`") if isinstance(x, str) else x


def _field(x: str | Lit) -> str:
    return sq(x.text) if isinstance(x, Lit) else f"cast({q(x)} as string)"


def render_delimited(cols: Sequence[str | Lit], sep: str = "|") -> Column:
    """Fields cast to string, NULL as '', joined by ``sep`` (one SQL expression)."""
    parts = ", ".join(f"coalesce({_field(c)}, '')" for c in cols)
    return F.expr(f"concat_ws({sq(sep)}, {parts})")


def render_quoted(cols: Sequence[str | Lit], raw: Sequence[str] = ()) -> Column:
    """``"a","b",...`` with every ``""`` pair deleted afterwards.

    Fields are NULL→'' except the names in ``raw``, whose NULL makes the whole
    line NULL (string concatenation propagates NULL). Deleting ``""`` also turns
    an empty field into nothing and removes a pair formed by a field that
    starts or ends with a double quote.
    """
    parts = []
    for c in cols:
        f = _field(c)
        parts.append(f if (isinstance(c, str) and c in raw) else f"coalesce({f}, '')")
    body = ", '\",\"', ".join(parts)
    return F.expr(f"replace(concat('\"', {body}, '\"'), '\"\"', '')")


def data_rows(df: DataFrame, lead: Sequence[str], text: Column) -> DataFrame:
    """Project the lead columns plus the report tail for data rows."""
    return df.select(*[_c(c) for c in lead], F.lit(DATA_ORDER).alias("REPORT_ORDER"),
                     F.lit(0).alias("IS_HEADER"), text.alias("REPORT_TEXT"))


def header_frame(spark, lines: Sequence[str]) -> DataFrame:
    """Header lines as rows ``(i, 1, line)`` for i = 1..n (configuration, not data)."""
    schema = StructType([StructField("REPORT_ORDER", IntegerType(), False),
                         StructField("IS_HEADER", IntegerType(), False),
                         StructField("REPORT_TEXT", StringType(), True)])
    return spark.createDataFrame([(i, 1, t) for i, t in enumerate(lines, start=1)], schema)


def with_header(data: DataFrame, lines: Sequence[str], distinct: bool = False) -> DataFrame:
    """Header rows (lead columns NULL) plus data rows; UNION or UNION ALL.

    The result is unordered; :func:`feedkit.sources.catalog.export_text` sorts by
    REPORT_ORDER then REPORT_TEXT when the file is written.
    """
    hdr = header_frame(data.sparkSession, lines)
    lead = [f for f in data.schema.fields if f.name not in TAIL]
    hdr = hdr.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in lead], *TAIL)
    out = data.select(*[_c(f.name) for f in lead], F.col("REPORT_ORDER").cast("int").alias("REPORT_ORDER"),
                      F.col("IS_HEADER").cast("int").alias("IS_HEADER"), "REPORT_TEXT").unionByName(hdr)
    return out.distinct() if distinct else out
