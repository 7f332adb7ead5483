"""Date and time column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def daylight_hours(sunrise="sunrise_at", sunset="sunset_at") -> Column:
    """whole seconds between sunrise and sunset, in hours (double)."""
    return F.timestamp_diff("SECOND", _c(sunrise), _c(sunset)) / F.lit(3600.0)


def date_parts(d, with_hour: bool = False) -> dict[str, Column]:
    """integer year, month, day, quarter (and hour for timestamps)."""
    d = _c(d)
    parts = {
        "year": F.year(d).cast("bigint"),
        "month": F.month(d).cast("bigint"),
        "day": F.dayofmonth(d).cast("bigint"),
        "quarter": F.quarter(d).cast("bigint"),
    }
    if with_hour:
        parts["hour"] = F.hour(d).cast("bigint")
    return parts


def dow0(d) -> Column:
    """day of week 0=Sunday .. 6=Saturday (Spark's dayofweek is 1=Sunday)."""
    return (F.dayofweek(_c(d)) - 1).cast("bigint")


def is_weekend(d) -> Column:
    """Saturday or Sunday."""
    return dow0(d).isin(0, 6)


def year_month(d) -> Column:
    """'YYYY-MM'."""
    return F.date_format(_c(d), "yyyy-MM")


def days_between(later, earlier) -> Column:
    """whole days later - earlier."""
    return F.datediff(_c(later), _c(earlier))


def hours_between(later, earlier) -> Column:
    """whole hours later - earlier, truncated toward zero."""
    return F.timestamp_diff("HOUR", _c(earlier), _c(later))


def season_south(d) -> Column:
    """Southern-hemisphere season from month and day."""
    d = _c(d)
    m, day = F.month(d), F.dayofmonth(d)
    summer = ((m == 12) & (day >= 21)) | m.isin(1, 2) | ((m == 3) & (day <= 20))
    autumn = ((m == 3) & (day >= 21)) | m.isin(4, 5) | ((m == 6) & (day <= 20))
    winter = ((m == 6) & (day >= 21)) | m.isin(7, 8) | ((m == 9) & (day <= 22))
    return (F.when(summer, "Verão").when(autumn, "Outono").when(winter, "Inverno")
            .otherwise("Primavera"))


# Pt-BR month and weekday names (weekdays from Sunday).
MONTH_NAMES_PT = ["Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
                  "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro"]
MONTH_ABBR_PT = ["Jan", "Fev", "Mar", "Abr", "Mai", "Jun", "Jul", "Ago", "Set", "Out", "Nov", "Dez"]
WEEKDAY_NAMES_PT = ["Domingo", "Segunda-feira", "Terça-feira", "Quarta-feira",
                    "Quinta-feira", "Sexta-feira", "Sábado"]
WEEKDAY_ABBR_PT = ["Dom", "Seg", "Ter", "Qua", "Qui", "Sex", "Sáb"]


def _pick(names: list[str], one_based: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), one_based)


def month_name_pt(d) -> Column:
    return _pick(MONTH_NAMES_PT, F.month(_c(d)))


def month_abbr_pt(d) -> Column:
    return _pick(MONTH_ABBR_PT, F.month(_c(d)))


def weekday_name_pt(d) -> Column:
    return _pick(WEEKDAY_NAMES_PT, F.dayofweek(_c(d)))


def weekday_abbr_pt(d) -> Column:
    return _pick(WEEKDAY_ABBR_PT, F.dayofweek(_c(d)))
