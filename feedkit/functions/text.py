"""Column-level helpers, built from Spark SQL built-ins (no UDFs).

Each helper takes column *names* and returns one :class:`Column` made from a
single SQL expression (``F.expr``): the whole expression tree crosses to the
JVM in one call, and it stays inside whole-stage codegen like any built-in.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def q(name: str) -> str:
    """Quote a column name as a SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def s(text: str) -> str:
    """Quote text as a SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def missing_sql(x: str) -> str:
    return f"(coalesce(cast({x} as string), '0') = '0')"


def missing(name: str) -> Column:
    """True when a text value is NULL or the string '0' (both mean 'no value')."""
    return F.expr(missing_sql(q(name)))


def _phone_sql(area: str, number: str, max_len: int) -> str:
    a, n = f"cast({q(area)} as string)", f"cast({q(number)} as string)"
    area_part = (f"CASE WHEN {missing_sql(a)} THEN '' WHEN length({a}) = 3 THEN concat({a}, '-') ELSE {a} END")
    number_part = (f"CASE WHEN {missing_sql(n)} THEN '' WHEN length({n}) = 7 "
                   f"THEN concat(substring({n}, 1, 3), '-', substring({n}, 4, 4)) ELSE {n} END")
    return f"substring(concat({area_part}, {number_part}), 1, {int(max_len)})"


def format_phone(area: str, number: str, max_len: int) -> Column:
    """``AAA-`` + ``NNN-NNNN``; other lengths pass through; NULL/'0' parts drop out.

    The joined text is cut to ``max_len`` characters.
    """
    return F.expr(_phone_sql(area, number, max_len))


def join_lines(line2: str, line3: str, variant: str = "append", max_len: int = 80) -> Column:
    """Join two address lines; the two variants differ on a missing first line.

    ``append``: ``line2`` (NULL→'') followed by ``' ' + line3`` when line 3 is
    present, so a missing line 2 with a line 3 gives ``' L3'``.
    ``guarded``: '' when line 2 is missing, else ``concat_ws(' ', line2, line3)``.
    """
    l2, l3 = q(line2), q(line3)
    if variant == "append":
        joined = f"concat_ws('', {l2}, ' ' || nullif({l3}, '0'))"
    elif variant == "guarded":
        joined = f"CASE WHEN {missing_sql(l2)} THEN '' ELSE concat_ws(' ', {l2}, {l3}) END"
    else:
        raise ValueError(f"unknown variant {variant!r}")
    return F.expr(f"substring({joined}, 1, {int(max_len)})")


def display_name(preferred: str, first: str, fallback: str | None = "NoName") -> Column:
    """Preferred name, else first name, else ``fallback`` ('0' counts as missing).

    With ``fallback=None`` the first name is returned as is (even NULL or '0').
    """
    p, f = q(preferred), q(first)
    if fallback is None:
        return F.expr(f"CASE WHEN {missing_sql(p)} THEN {f} ELSE {p} END")
    return F.expr(f"CASE WHEN {missing_sql(p)} THEN CASE WHEN {missing_sql(f)} THEN {s(fallback)} ELSE {f} END "
                  f"ELSE {p} END")


def patron_class(level: str, classification: str, graduate: str = "graduate", graduate_code: str = "GRAD2",
                 renames: dict[str, str] | None = None) -> Column:
    """Upper-cased ``level-class`` code; graduates get a fixed code.

    Class names listed in ``renames`` (lower-case key) are replaced first and
    spaces become dashes. NULL parts are empty.
    """
    # Fixed values that must equal the reference's: the class rename table.
    renames = {"freshmen": "FRESHMAN"} if renames is None else renames
    lv, cl = q(level), q(classification)
    names = ", ".join(f"{s(k)}, {s(v)}" for k, v in renames.items())
    named = f"coalesce(element_at(map({names}), lower({cl})), {cl})" if renames else cl
    return F.expr(f"upper(if(lower({lv}) = {s(graduate)}, {s(graduate_code)}, "
                  f"concat_ws('', {lv}, '-', replace({named}, ' ', '-'))))")


def utc_wall(instant: Column) -> Column:
    """The UTC wall-clock time of a TIMESTAMP, whatever the session's zone."""
    seconds = (F.unix_micros(instant.cast("timestamp")) / 1_000_000).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def hour_gate(now_utc: str | Column, tz: str = "America/New_York", modulus: int = 2) -> Column:
    """True when the local hour of the UTC instant in ``tz`` is a multiple of ``modulus``."""
    c = F.col(now_utc) if isinstance(now_utc, str) else now_utc
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), c.cast("timestamp_ntz"))
    return (F.hour(local) % modulus) == 0


def is_current(change_ind: str) -> Column:
    """Current identity/name row: change indicator is NULL."""
    return F.col(change_ind).isNull()


def open_on(end_date: str, as_of: Column) -> Column:
    """Open-ended or not yet ended on ``as_of``."""
    e = F.col(end_date)
    return e.isNull() | (as_of <= e)


def still_active(to_date: str, as_of: Column) -> Column:
    """Strictly after ``as_of`` (a NULL end is not active)."""
    return F.col(to_date) > as_of


def season_suffix(term: str) -> Column:
    """Last two characters of a 6-character term code (10/20/30/40 seasons)."""
    return F.expr(f"substring({q(term)}, -2, 2)")


def quoted_field_safe(name: str) -> Column:
    """Strip double quotes from a field before it goes into a quoted line."""
    return F.expr(f"replace({q(name)}, '\"', '')")
