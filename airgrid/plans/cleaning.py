"""Readings to the finished data set."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airgrid import config
from airgrid.operators import align, features, quality, sequence
from airgrid.session import stored


@dataclass(frozen=True)
class Cleaned:
    """The results of one cleaning run; every part is a lazy table.

    They read the aligned and the tagged rows, which are written once.
    """

    dataset: DataFrame
    audit: DataFrame
    anomalies: DataFrame
    completeness: DataFrame
    gaps: DataFrame


def clean_readings(
    readings: DataFrame,
    variables: Sequence[str] = config.VARIABLES,
    target: str = config.TARGET,
    exclude: bool = True,
    period: tuple[str, str] = (config.EXCLUDED_START, config.EXCLUDED_END),
    gap_hours: float = config.GAP_HOURS,
    rules: Sequence[str] = quality.DEFAULT_RULES,
    exact_times: bool = False,
) -> Cleaned:
    """All stations at once: clean values, align, apply the row rules, add features.

    ``readings`` is long: (station, variable, ts, value, arrival). Values are cleaned
    before the alignment, where they are still one column. Times are taken to the full
    hour; with ``exact_times`` they stay as they are, up to one row per second.
    """
    cleaned = quality.clean_values(readings)
    to_align = cleaned.select(
        "station", "variable", "ts", F.col("clean_value").alias("value"), "arrival"
    )
    aligner = align.align if exact_times else align.align_hourly
    cell = sequence.day_cell if exact_times else sequence.month_cell
    aligned = stored(aligner(to_align, variables))
    pollutants = [v for v in variables if v in config.POLLUTANTS]
    applied = [r for r in rules if exclude or r != quality.PERIOD]
    tagged = stored(
        quality.tag_removals(
            aligned, target, pollutants, applied, period=period, gap_hours=gap_hours, cell=cell
        )
    )
    kept = tagged.filter("removed_by is null").drop("removed_by")
    return Cleaned(
        dataset=features.add_dataset_columns(kept, target, cell=cell),
        audit=quality.removal_audit(tagged, applied, ("station",)),
        anomalies=quality.anomaly_count(cleaned),
        completeness=quality.completeness(readings, variables),
        gaps=quality.gap_blocks(aligned, pollutants, longer_than=gap_hours, cell=cell),
    )
