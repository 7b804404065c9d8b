"""Names: files, stations, columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_stem(name: Column) -> Column:
    """Last path part without its extension."""
    return F.regexp_replace(F.element_at(F.split(name, "/"), -1), r"(?<=.)\.[^.]*$", "")


def normalised_stem(name: Column) -> Column:
    """Stem in upper case with letters and digits only."""
    return F.regexp_replace(F.upper(file_stem(name)), "[^A-Z0-9]", "")


def _no_edges(text: Column) -> Column:
    return F.regexp_replace(text, r"^[._\-]+|[._\-]+$", "")


def safe_dataset_name(name: Column, fallback: str) -> Column:
    cleaned = _no_edges(F.regexp_replace(name, r"(?U)[^\w\-]+", "_"))
    return F.coalesce(F.nullif(cleaned, F.lit("")), F.lit(fallback))


def safe_model_name(name: Column, fallback: str) -> Column:
    """Like the data set name, but dots stay and a ``.pkl`` ending goes first."""
    base = F.regexp_replace(F.trim(name), r"(?i)\.pkl$", "")
    cleaned = _no_edges(F.regexp_replace(base, r"(?U)[^\w\-.]+", "_"))
    return F.coalesce(F.nullif(cleaned, F.lit("")), F.lit(fallback))


def station_from_file(name: Column) -> Column:
    """Title case: a letter after anything but a letter is a capital, the others are small."""
    spaced = F.replace(file_stem(name), F.lit("_"), F.lit(" "))
    runs = F.regexp_extract_all(spaced, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda run: F.initcap(run)), "")


def similarity(feature: Column, target: Column) -> Column:
    """How a feature name relates to a target name.

    ``exacto``: the same name in any case. ``prefijo``: the target name followed
    by ``_``, ``-``, ``.`` or a digit. ``silencio``: anything else.
    """
    name, base = F.upper(feature), F.upper(target)
    following = F.substring(name, F.length(base) + 1, F.lit(1))
    return (
        F.when(name == base, F.lit("exacto"))
        .when(F.startswith(name, base) & following.rlike(r"[_\-.0-9]"), F.lit("prefijo"))
        .otherwise(F.lit("silencio"))
    )


def lag_base(feature: Column) -> Column:
    """``X`` of ``X_lag_24h``, NULL for other names."""
    return F.nullif(F.regexp_extract(feature, r"^(.+)_lag_(\d+)h$", 1), F.lit(""))


def lag_hours(feature: Column) -> Column:
    """``24`` of ``X_lag_24h``, NULL for other names."""
    return F.regexp_extract(feature, r"^(.+)_lag_(\d+)h$", 2).try_cast("int")


def lag_parts(feature: str) -> tuple[str, int] | None:
    """(X, 24) of the name ``X_lag_24h``, None for other names."""
    found = re.fullmatch(r"(.+)_lag_(\d+)h", feature)
    return (found[1], int(found[2])) if found else None
