"""Clock, calendar and wind features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def on_circle(position: Column, length: float) -> tuple[Column, Column]:
    """Sine and cosine of a position on a cycle of the given length."""
    angle = F.lit(2.0) * F.pi() * position / F.lit(float(length))
    return F.sin(angle), F.cos(angle)


def cyclic_columns(ts: Column, minutes: bool = False) -> dict[str, Column]:
    """Hour and month on their circles; with ``minutes`` the hour is fractional."""
    hour = F.hour(ts).cast("double")
    if minutes:
        hour = hour + F.minute(ts) / F.lit(60.0)
    hour_sin, hour_cos = on_circle(hour, 24)
    month_sin, month_cos = on_circle(F.month(ts).cast("double"), 12)
    return {
        "hora_sin": hour_sin,
        "hora_cos": hour_cos,
        "mes_sin": month_sin,
        "mes_cos": month_cos,
    }


def weekday_columns(ts: Column) -> dict[str, Column]:
    """Monday is 0; Saturday and Sunday are the weekend."""
    day = F.weekday(ts)
    day_sin, day_cos = on_circle(day.cast("double"), 7)
    return {
        "dia_semana": day,
        "dia_semana_sin": day_sin,
        "dia_semana_cos": day_cos,
        "es_finde": (day >= 5).cast("int"),
    }


def wind_columns(speed: Column, direction: Column) -> dict[str, Column]:
    angle = F.radians(direction)
    return {"wind_u": speed * F.cos(angle), "wind_v": speed * F.sin(angle)}


def interaction_columns(
    temperature: Column | None, humidity: Column | None, speed: Column | None
) -> dict[str, Column]:
    """Products of weather columns; a product is left out if an input is missing."""
    columns = {}
    if temperature is not None and humidity is not None:
        columns["temp_hum"] = temperature * humidity
    if temperature is not None and speed is not None:
        columns["temp_wind"] = temperature * speed
    return columns


def hours_between(start: Column, end: Column) -> Column:
    """Signed distance of two zone-free timestamps in hours, with its fraction."""

    def seconds_of_day(ts: Column) -> Column:
        return (
            F.hour(ts) * 3600 + F.minute(ts) * 60 + F.extract(F.lit("SECOND"), ts).cast("double")
        )

    days = F.datediff(end.cast("date"), start.cast("date"))
    return days * F.lit(24.0) + (seconds_of_day(end) - seconds_of_day(start)) / F.lit(3600.0)
