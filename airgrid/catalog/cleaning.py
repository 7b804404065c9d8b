"""Queries over readings: scans, casts, rules, completeness, audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from airgrid.catalog import views as v
from airgrid.catalog.registry import query, r6, s6, s_ts, ts_text, with_sql
from airgrid.functions import text, values
from airgrid.operators import align as al
from airgrid.operators import quality as qu
from airgrid.session import stored
from airgrid.sources import tables

EXPECTED = (*v.VARIABLES, "refund", "logout")
GAP_COLUMNS = ("purchase", "signup")
RANGES = {name: (0.0, 200.0) for name in v.VARIABLES if name != "error"}
CODED = (
    "CASE WHEN arrival % 101 = 0 THEN -999.0 WHEN arrival % 103 = 0 THEN 9999.0 "
    "ELSE value END"
)
CLEAN = (
    f"coded AS (SELECT *, CAST({CODED} AS DOUBLE) AS raw FROM readings), "
    "clean AS (SELECT *, CASE WHEN raw IN (-999, -9999, 9999) THEN NULL "
    "WHEN variable <> 'error' AND (raw < 0 OR raw > 200) THEN NULL "
    "ELSE raw END AS clean_value FROM coded)"
)


def _coded(spark, sf):
    """Readings with some sensor codes injected by rule."""
    readings = v.readings(spark, sf)
    value = F.expr(CODED).cast("double")
    return qu.clean_values(readings.withColumn("value", value), ranges=RANGES)


@query(
    "scan_status",
    "WITH expected(variable) AS (SELECT unnest(['"
    + "', '".join(EXPECTED)
    + "'])), found AS (SELECT event_type, min(event_type || '_' || (user_id % 3) || '.csv') AS f "
    "FROM events GROUP BY 1) "
    "SELECT variable, CASE WHEN f IS NULL THEN 'No encontrado' ELSE 'Cargado' END AS status, "
    "coalesce(f, '—') AS file FROM expected LEFT JOIN found ON event_type = variable",
)
def scan_status(spark, sf):
    """Expected variables against those that occur."""
    expected = spark.range(1).select(F.explode(F.array(*map(F.lit, EXPECTED))).alias("variable"))
    named = v.table(spark, sf, "events").select(
        F.col("event_type").alias("variable"),
        F.concat_ws("", "event_type", F.lit("_"), F.col("user_id") % 3, F.lit(".csv")).alias("file"),
    )
    found = named.groupBy("variable").agg(F.min("file").alias("file"))
    return qu.file_status(expected, found)


@query(
    "dataset_metadata",
    with_sql(
        v.READINGS,
        "SELECT station, count(*) AS n_rows, "
        + s_ts("min(ts)", "first_ts")
        + ", "
        + s_ts("max(ts)", "last_ts")
        + ", CAST(floor(epoch(max(ts) - min(ts)) / 86400) AS BIGINT) AS n_days "
        "FROM readings GROUP BY station",
    ),
)
def dataset_metadata(spark, sf):
    summary = qu.dataset_summary(v.readings(spark, sf))
    return summary.select(
        "station",
        "n_rows",
        ts_text("first_ts").alias("first_ts"),
        ts_text("last_ts").alias("last_ts"),
        "n_days",
    )


@query(
    "preview_rows",
    with_sql(
        v.READINGS,
        "SELECT station, " + s_ts("t", "ts") + ", variable, value FROM "
        "(SELECT station, ts AS t, arrival, variable, value FROM readings "
        "ORDER BY station, t, arrival LIMIT 100)",
    ),
)
def preview_rows(spark, sf):
    """The first 100 rows by station and time."""
    rows = tables.preview(v.readings(spark, sf), ("station", "ts", "arrival"))
    return rows.select("station", "ts", "variable", "value")


@query(
    "safe_names",
    "WITH raw AS (SELECT p_partkey, p_name, CASE WHEN p_partkey % 50 = 7 THEN '...' ELSE "
    "' ' || p_name || ' (' || p_brand || ')_' || CASE WHEN p_partkey % 2 = 0 THEN '.pkl' ELSE '' END "
    "END AS raw FROM part), "
    "model AS (SELECT *, regexp_replace(trim(raw), '\\.pkl$', '', 'i') AS base FROM raw) "
    "SELECT p_partkey, "
    "coalesce(nullif(regexp_replace(regexp_replace(base, '[^\\w\\-.]+', '_', 'g'), "
    "'^[._\\-]+|[._\\-]+$', '', 'g'), ''), 'model') AS model_name, "
    "coalesce(nullif(regexp_replace(regexp_replace(raw, '[^\\w\\-]+', '_', 'g'), "
    "'^[._\\-]+|[._\\-]+$', '', 'g'), ''), 'dataset') AS dataset_name, "
    "array_to_string([upper(w[1]) || lower(w[2:]) FOR w IN "
    "regexp_extract_all(p_name || ' 2b-x', '[a-zA-Z]+|[^a-zA-Z]+')], '') AS station FROM model",
)
def safe_names(spark, sf):
    raw = F.when(F.col("p_partkey") % 50 == 7, "...").otherwise(
        F.concat(
            F.lit(" "),
            "p_name",
            F.lit(" ("),
            "p_brand",
            F.lit(")_"),
            F.when(F.col("p_partkey") % 2 == 0, ".pkl").otherwise(""),
        )
    )
    file = F.concat(
        F.lit("/data/"), F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_2b-x.csv")
    )
    return v.table(spark, sf, "part").select(
        "p_partkey",
        text.safe_model_name(raw, "model").alias("model_name"),
        text.safe_dataset_name(raw, "dataset").alias("dataset_name"),
        text.station_from_file(file).alias("station"),
    )


@query(
    "columns_per_file",
    with_sql(
        v.READINGS,
        "SELECT variable, count(DISTINCT station) AS n_stations, "
        "string_agg(DISTINCT CAST(station AS VARCHAR), ', ' ORDER BY CAST(station AS VARCHAR)) "
        "AS stations FROM readings GROUP BY variable",
    ),
)
def columns_per_file(spark, sf):
    named = v.readings(spark, sf).withColumn("station", F.col("station").cast("string"))
    return qu.columns_per_file(named)


@query(
    "unpivot_measures",
    "WITH long AS ("
    + " UNION ALL ".join(
        f"SELECT l_orderkey, l_linenumber, '{m.upper()}' AS measure, {m} AS value FROM lineitem"
        for m in v.MEASURES
    )
    + ") SELECT l_orderkey, l_linenumber, measure, "
    + s6("sum(value)", "value")
    + " FROM long GROUP BY ALL",
)
def unpivot_measures(spark, sf):
    ids = ("l_orderkey", "l_linenumber")
    long = al.unpivot_stations(v.measures(spark, sf), ids, v.MEASURES, "measure", "value")
    return long.groupBy(*ids, "measure").agg(r6(F.sum("value")).alias("value"))


@query(
    "drop_unit_rows",
    "SELECT p_partkey, p_name FROM part WHERE NOT regexp_matches(p_name, "
    "'unidad|unit|ug|mg|%|m/s|°|grados|ring', 'i')",
)
def drop_unit_rows(spark, sf):
    """Here ``ring`` stands in for one more unit, as no part name holds a real one."""
    pattern = "unidad|unit|ug|mg|%|m/s|°|grados|ring"
    return al.drop_unit_rows(
        v.table(spark, sf, "part").select("p_partkey", "p_name"), "p_name", pattern
    )


@query(
    "coerce_types",
    "WITH spoiled AS (SELECT event_id, "
    "CASE WHEN event_id % 97 = 0 THEN 'sin dato' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS t, "
    "CASE WHEN event_id % 89 = 0 THEN '12,5' WHEN event_id % 83 = 0 THEN 'NaN' "
    "ELSE CAST(value AS VARCHAR) END AS x, epoch(ts) AS s FROM events), "
    "cast_ AS (SELECT event_id, TRY_CAST(t AS TIMESTAMP) AS t, TRY_CAST(x AS DOUBLE) AS x, "
    "make_timestamp(CAST(floor(s) AS BIGINT) * 1000000) AS u FROM spoiled) "
    "SELECT event_id, "
    + s_ts("t", "ts")
    + ", CASE WHEN isnan(x) THEN NULL ELSE x END AS value, "
    + s_ts("u", "from_unix")
    + " FROM cast_ WHERE t IS NOT NULL",
)
def coerce_types(spark, sf):
    """Texts to times and numbers; rows without a time go, other failures are NULL."""
    spoiled = v.table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_id") % 97 == 0, "sin dato").otherwise(ts_text("ts")).alias("t"),
        F.when(F.col("event_id") % 89 == 0, "12,5")
        .when(F.col("event_id") % 83 == 0, "NaN")
        .otherwise(F.col("value").cast("string"))
        .alias("x"),
        F.expr(
            "datediff(ts, DATE'1970-01-01') * 86400L + hour(ts) * 3600 + minute(ts) * 60 + second(ts)"
        ).alias("s"),
    )
    typed = spoiled.select(
        "event_id",
        values.to_time(F.col("t")).alias("t"),
        values.to_number(F.col("x")).alias("value"),
        values.epoch_to_time(F.col("s")).alias("u"),
    ).filter(F.col("t").isNotNull())
    return typed.select(
        "event_id", ts_text("t").alias("ts"), "value", ts_text("u").alias("from_unix")
    )


_SEARCH = (
    "CASE s_suppkey % 3 WHEN 0 THEN lower(s_name) || ' ' WHEN 1 THEN right(s_name, 2) "
    "ELSE 'x' || s_name END"
)


@query(
    "match_station",
    f"WITH searches AS (SELECT DISTINCT {_SEARCH} AS search FROM supplier), "
    "pairs AS (SELECT search, s_name, s_suppkey, upper(s_name) = upper(trim(search)) AS same "
    "FROM searches JOIN supplier ON contains(upper(s_name), upper(trim(search)))), "
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY search "
    "ORDER BY same DESC, s_suppkey) AS rn FROM pairs) "
    "SELECT searches.search, s_name AS matched, CASE WHEN same THEN 'exact' "
    "WHEN s_name IS NOT NULL THEN 'partial' ELSE 'missing' END AS kind "
    "FROM searches LEFT JOIN ranked ON ranked.search = searches.search AND rn = 1",
)
def match_station(spark, sf):
    suppliers = v.table(spark, sf, "supplier")
    searches = suppliers.select(F.expr(_SEARCH).alias("search"))
    return al.match_station(searches, suppliers, "search", "s_name", "s_suppkey")


@query(
    "clean_codes_ranges",
    with_sql(v.READINGS, CLEAN, "SELECT arrival AS event_id, clean_value FROM clean"),
)
def clean_codes_ranges(spark, sf):
    return _coded(spark, sf).select(F.col("arrival").alias("event_id"), "clean_value")


@query(
    "anomaly_count",
    with_sql(
        v.READINGS,
        CLEAN,
        "SELECT variable, count(*) FILTER (raw IS NOT NULL AND clean_value IS NULL) AS n_nulled "
        "FROM clean GROUP BY variable",
    ),
)
def anomaly_count(spark, sf):
    return qu.anomaly_count(_coded(spark, sf))


@query(
    "exclude_period",
    "SELECT o_orderkey, "
    + s_ts("o_orderdate", "o_orderdate")
    + " FROM orders WHERE NOT (o_orderdate >= TIMESTAMP '1998-01-01' "
    "AND o_orderdate <= TIMESTAMP '1999-12-31')",
)
def exclude_period(spark, sf):
    kept = qu.exclude_period(
        v.table(spark, sf, "orders"), "o_orderdate", "1998-01-01", "1999-12-31"
    )
    return kept.select("o_orderkey", ts_text("o_orderdate").alias("o_orderdate"))


@query(
    "exclude_years",
    "SELECT o_orderkey, "
    + s_ts("o_orderdate", "o_orderdate")
    + " FROM orders WHERE year(o_orderdate) NOT IN (1996, 1997)",
)
def exclude_years(spark, sf):
    kept = qu.exclude_years(v.table(spark, sf, "orders"), "o_orderdate", (1996, 1997))
    return kept.select("o_orderkey", ts_text("o_orderdate").alias("o_orderdate"))


@query(
    "align_hourly",
    with_sql(
        v.READINGS,
        v.HOURLY,
        "SELECT station, "
        + s_ts("ts", "ts")
        + ", "
        + ", ".join(s6(f'"{c}"', f'"{c}"') for c in v.VARIABLES)
        + " FROM hourly",
    ),
)
def align_hourly(spark, sf):
    return v.hourly(spark, sf).select(
        "station", ts_text("ts").alias("ts"), *[r6(c).alias(c) for c in v.VARIABLES]
    )


@query(
    "align_first",
    with_sql(
        v.USER_HOURLY,
        "SELECT user_id, " + s_ts("ts", "ts") + ", "
        + ", ".join(f'"{c}"' for c in v.VARIABLES) + " FROM user_hourly",
    ),
)
def align_first(spark, sf):
    """Outer alignment that keeps the first reading to arrive."""
    return v.user_hourly(spark, sf).withColumn("ts", ts_text("ts"))


@query(
    "require_target",
    with_sql(
        v.READINGS,
        v.HOURLY,
        "SELECT station, " + s_ts("ts", "ts") + ", " + s6('"view"', '"view"')
        + ' FROM hourly WHERE "view" IS NOT NULL',
    ),
)
def require_target(spark, sf):
    kept = qu.require_target(v.hourly(spark, sf), "view")
    return kept.select("station", ts_text("ts").alias("ts"), r6("view").alias("view"))


@query(
    "require_any",
    with_sql(
        v.READINGS,
        v.HOURLY,
        "SELECT station, " + s_ts("ts", "ts") + ", " + s6("purchase", "purchase") + ", "
        + s6("signup", "signup")
        + " FROM hourly WHERE purchase IS NOT NULL OR signup IS NOT NULL",
    ),
)
def require_any(spark, sf):
    kept = qu.require_any(v.hourly(spark, sf), GAP_COLUMNS)
    return kept.select(
        "station", ts_text("ts").alias("ts"), *[r6(c).alias(c) for c in GAP_COLUMNS]
    )


@query(
    "drop_any_null",
    with_sql(
        v.READINGS,
        v.HOURLY,
        "SELECT station, count(*) FILTER ("
        + " AND ".join(f'"{c}" IS NOT NULL' for c in v.VARIABLES)
        + ") AS n_kept, CAST(sum("
        + " + ".join(f'CAST("{c}" IS NULL AS INT)' for c in v.VARIABLES)
        + ") AS BIGINT) AS n_nulls FROM hourly GROUP BY station",
    ),
)
def drop_any_null(spark, sf):
    """Rows complete in all columns, and the NULL cells over them; hours are aligned once."""
    hourly = stored(v.hourly(spark, sf))
    nulls = hourly.groupBy("station").agg(qu.null_total(hourly, v.VARIABLES).alias("n_nulls"))
    kept = qu.require_all(hourly).groupBy("station").agg(F.count(F.lit(1)).alias("n_kept"))
    return nulls.join(kept, "station", "left").select(
        "station", F.coalesce("n_kept", F.lit(0)).alias("n_kept"), "n_nulls"
    )


@query(
    "last_n_days",
    "SELECT user_id, event_id, " + s_ts("ts", "ts") + " FROM (SELECT *, max(ts) OVER "
    "(PARTITION BY user_id) AS last FROM events) WHERE ts >= last - INTERVAL 7 DAY",
)
def last_n_days(spark, sf):
    recent = qu.last_days(v.table(spark, sf, "events"), ("user_id",), 7)
    return recent.select("user_id", "event_id", ts_text("ts").alias("ts"))


@query(
    "min_rows_guard",
    with_sql(
        v.READINGS,
        "SELECT station, variable, count(*) AS n_rows, "
        "CASE WHEN count(*) >= 200 THEN 'ok' ELSE 'too_few' END AS status "
        "FROM readings GROUP BY 1, 2",
    ),
)
def min_rows_guard(spark, sf):
    return qu.min_rows_guard(v.readings(spark, sf), ("station", "variable"), 200)


_EXPECTED_SQL = "['" + "', '".join(v.VARIABLES) + "']"


@query(
    "completeness",
    "WITH present AS (SELECT user_id || ':' || hour(ts) AS station, list(DISTINCT event_type) AS p "
    "FROM events WHERE value IS NOT NULL GROUP BY 1), "
    f"parts AS (SELECT station, [x FOR x IN {_EXPECTED_SQL} IF list_contains(p, x)] AS have, "
    f"[x FOR x IN {_EXPECTED_SQL} IF NOT list_contains(p, x)] AS miss FROM present) "
    "SELECT station, CAST(len(have) AS BIGINT) AS n_present, array_to_string(have, ',') AS present, "
    "array_to_string(miss, ',') AS missing, len(miss) <= 1 AS eligible FROM parts",
)
def completeness(spark, sf):
    """Which variables each series has; a user's hour of the day is a series, so that some lack."""
    readings = v.table(spark, sf, "events").select(
        F.concat_ws(":", F.col("user_id").cast("string"), F.hour("ts").cast("string")).alias("station"),
        F.col("event_type").alias("variable"),
        "value",
    )
    return qu.completeness(readings, v.VARIABLES).select(
        "station",
        "n_present",
        F.array_join("present", ",").alias("present"),
        F.array_join("missing", ",").alias("missing"),
        "eligible",
    )


@query(
    "list_stations",
    "SELECT DISTINCT upper(n_name) AS station FROM nation JOIN "
    "(SELECT s_nationkey AS k FROM supplier UNION ALL SELECT c_nationkey FROM customer) "
    "ON k = n_nationkey",
)
def list_stations(spark, sf):
    """Names in use over two tables."""
    nation = v.table(spark, sf, "nation")

    def named(table, key):
        keys = v.table(spark, sf, table).select(F.col(key).alias("n_nationkey")).distinct()
        return nation.join(keys, "n_nationkey").select(F.lower("n_name").alias("station"))

    return qu.list_stations(named("supplier", "s_nationkey"), named("customer", "c_nationkey"))


@query(
    "series_coverage",
    with_sql(
        v.READINGS,
        "SELECT station, variable, count(value) AS n_values, "
        "strftime(min(ts), '%Y-%m-%d') AS first_date, strftime(max(ts), '%Y-%m-%d') AS last_date "
        "FROM readings GROUP BY 1, 2",
    ),
)
def series_coverage(spark, sf):
    coverage = qu.series_coverage(v.readings(spark, sf))
    return coverage.withColumns(
        {c: F.col(c).cast("string") for c in ("first_date", "last_date")}
    )


@query(
    "profile",
    with_sql(
        v.READINGS,
        v.HOURLY,
        " UNION ALL ".join(
            f"SELECT '{c}' AS variable, count(\"{c}\") AS n_valid, "
            f"round((count(*) - count(\"{c}\")) * 100.0::DOUBLE / count(*), 1) AS pct_null, "
            f"round(avg(\"{c}\"), 3) AS mean, round(min(\"{c}\"), 3) AS min, "
            f"round(max(\"{c}\"), 3) AS max FROM {source}"
            for source, columns in (("hourly", v.VARIABLES), ("lineitem", v.MEASURES))
            for c in columns
        ),
    ),
)
def profile(spark, sf):
    sparse = qu.profile(v.hourly(spark, sf), v.VARIABLES)
    return sparse.unionByName(qu.profile(v.measures(spark, sf), v.MEASURES))


_ISLANDS = (
    "flagged AS (SELECT *, purchase IS NULL AND signup IS NULL AS silent FROM {source}), "
    "changes AS (SELECT *, CASE WHEN silent IS DISTINCT FROM lag(silent) OVER "
    "(PARTITION BY user_id ORDER BY ts) THEN 1 ELSE 0 END AS change FROM flagged), "
    "numbered AS (SELECT *, sum(change) OVER (PARTITION BY user_id ORDER BY ts) AS blk FROM changes), "
    "blocks AS (SELECT user_id, blk, min(ts) AS a, max(ts) AS b, count(*) AS n, "
    "epoch(max(ts) - min(ts)) / 3600 AS hours FROM numbered WHERE silent GROUP BY 1, 2)"
)


@query(
    "gap_blocks",
    with_sql(
        v.USER_HOURLY,
        _ISLANDS.format(source="user_hourly"),
        "SELECT user_id, " + s_ts("a", "first_ts") + ", " + s_ts("b", "last_ts") + ", "
        + s6("hours", "hours") + ", n AS n_rows, hours > 24 AS too_long FROM blocks",
    ),
)
def gap_blocks(spark, sf):
    runs = qu.gap_blocks(stored(v.user_hourly(spark, sf)), GAP_COLUMNS, ("user_id",))
    return runs.select(
        "user_id",
        ts_text("first_ts").alias("first_ts"),
        ts_text("last_ts").alias("last_ts"),
        r6("hours").alias("hours"),
        "n_rows",
        (F.col("hours") > 24).alias("too_long"),
    )


@query(
    "gap_filter",
    with_sql(
        v.USER_HOURLY,
        _ISLANDS.format(source="user_hourly"),
        "SELECT user_id, " + s_ts("ts", "ts") + " FROM numbered LEFT JOIN blocks "
        "USING (user_id, blk) WHERE NOT (silent AND hours > 24)",
    ),
)
def gap_filter(spark, sf):
    kept = qu.drop_long_gaps(stored(v.user_hourly(spark, sf)), GAP_COLUMNS, keys=("user_id",))
    return kept.select("user_id", ts_text("ts").alias("ts"))


AUDIT_RULES = (qu.PERIOD, qu.GAP, qu.ANY, qu.TARGET)


def _tagged(spark, sf):
    return qu.tag_removals(
        stored(v.user_hourly(spark, sf)),
        target="view",
        pollutants=("view", *GAP_COLUMNS),
        rules=AUDIT_RULES,
        keys=("user_id",),
        period=("2024-01-10", "2024-01-12"),
    )


@query(
    "removal_audit",
    with_sql(
        v.USER_HOURLY,
        "outside AS (SELECT * FROM user_hourly WHERE NOT (ts >= TIMESTAMP '2024-01-10' "
        "AND ts <= TIMESTAMP '2024-01-12'))",
        _ISLANDS.format(source="outside").replace(
            "purchase IS NULL AND signup IS NULL",
            '"view" IS NULL AND purchase IS NULL AND signup IS NULL',
        ),
        "ungapped AS (SELECT * FROM numbered LEFT JOIN blocks USING (user_id, blk) "
        "WHERE NOT (silent AND hours > 24))",
        "known AS (SELECT * FROM ungapped WHERE NOT silent)",
        'final AS (SELECT * FROM known WHERE "view" IS NOT NULL)',
        "n AS (SELECT (SELECT count(*) FROM user_hourly) AS n0, (SELECT count(*) FROM outside) AS n1, "
        "(SELECT count(*) FROM ungapped) AS n2, (SELECT count(*) FROM known) AS n3, "
        "(SELECT count(*) FROM final) AS n4)",
        "SELECT step, stage, n_rows, " + s6("n_rows * 100.0::DOUBLE / n0", "pct") + " FROM ("
        "SELECT 1 AS step, 'period' AS stage, n0 - n1 AS n_rows, n0 FROM n UNION ALL "
        "SELECT 2, 'gap', n1 - n2, n0 FROM n UNION ALL SELECT 3, 'any', n2 - n3, n0 FROM n UNION ALL "
        "SELECT 4, 'target', n3 - n4, n0 FROM n UNION ALL SELECT 5, 'kept', n4, n0 FROM n)",
    ),
)
def removal_audit(spark, sf):
    audit = qu.removal_audit(_tagged(spark, sf), AUDIT_RULES)
    return audit.withColumn("pct", r6("pct"))


@query(
    "duplicate_timestamps",
    with_sql(
        v.READINGS,
        "SELECT station, count(*) - count(DISTINCT date_trunc('hour', ts)) AS n_duplicates "
        "FROM readings GROUP BY station",
    ),
)
def duplicate_timestamps(spark, sf):
    """Readings beyond the first of each hour."""
    hourly = v.readings(spark, sf).withColumn("ts", values.hour_of(F.col("ts")))
    return qu.duplicate_times(hourly)


@query(
    "monotonic_check",
    "SELECT o_orderpriority, count(*) FILTER (previous > o_orderdate) AS n_unsorted FROM "
    "(SELECT *, lag(o_orderdate) OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) "
    "AS previous FROM orders) GROUP BY 1",
)
def monotonic_check(spark, sf):
    """Orders dated before the order that arrived just before them."""
    return qu.unsorted_times(
        v.table(spark, sf, "orders"), ("o_orderpriority",), "o_orderdate", "o_orderkey"
    )


@query(
    "validate_dataset",
    with_sql(
        "wide AS (SELECT user_id, date_trunc('hour', ts) AS ts, event_id, "
        + ", ".join(f"CASE WHEN event_type = '{c}' THEN value END AS \"{c}\"" for c in v.VARIABLES)
        + " FROM events)",
        "prior AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY event_id) AS previous FROM wide)",
        "SELECT 'target_null' AS rule, count(*) FILTER (\"view\" IS NULL) AS n_violations FROM wide "
        "UNION ALL SELECT 'no_pollutant', count(*) FILTER (\"view\" IS NULL AND purchase IS NULL) "
        "FROM wide UNION ALL SELECT 'duplicate_time', count(*) - count(DISTINCT (user_id, ts)) FROM wide "
        "UNION ALL SELECT 'unsorted', count(*) FILTER (previous > ts) FROM prior",
    ),
)
def validate_dataset(spark, sf):
    """The finished-data rules on rows that break some of them."""
    wide = v.table(spark, sf, "events").select(
        "user_id",
        values.hour_of(F.col("ts")).alias("ts"),
        F.col("event_id").alias("arrival"),
        *[F.when(F.col("event_type") == c, F.col("value")).alias(c) for c in v.VARIABLES],
    )
    return qu.validate_dataset(wide, "view", ("view", "purchase"), ("user_id",))


_HEADER = (
    "CASE p_partkey % 4 WHEN 0 THEN p_type || '_' || p_size WHEN 1 THEN lower(p_type) "
    "WHEN 2 THEN p_type || '4' ELSE p_brand || p_type END"
)
TARGETS = ("ECONOMY", "SMALL", "MEDIUM", "PROMO", "STANDARD", "LARGE")


@query(
    "similarity_classes",
    f"WITH features AS (SELECT DISTINCT {_HEADER} AS feature FROM part), "
    "targets AS (SELECT unnest(['" + "', '".join(TARGETS) + "']) AS target) "
    "SELECT feature, target, CASE WHEN upper(feature) = upper(target) THEN 'exacto' "
    "WHEN regexp_matches(upper(feature), '^' || upper(target) || '[_\\-.0-9]') THEN 'prefijo' "
    "ELSE 'silencio' END AS kind FROM features, targets",
)
def similarity_classes(spark, sf):
    """Column names met in the parts table against a fixed list of targets."""
    features = v.table(spark, sf, "part").select(F.expr(_HEADER).alias("feature")).distinct()
    return features.select(
        "feature", F.explode(F.array(*map(F.lit, TARGETS))).alias("target")
    ).withColumn("kind", text.similarity(F.col("feature"), F.col("target")))


@query(
    "lag_confirmation",
    f"WITH features AS (SELECT DISTINCT {_HEADER} AS feature FROM part), "
    "targets AS (SELECT unnest(['" + "', '".join(TARGETS) + "']) AS base) "
    "SELECT feature, base, 'X (lag/derivado)' AS role FROM features, targets "
    "WHERE regexp_matches(upper(feature), '^' || upper(base) || '[_\\-.0-9]')",
)
def lag_confirmation(spark, sf):
    """Names that start like a target and are to be confirmed as features."""
    pairs = similarity_classes(spark, sf).filter("kind = 'prefijo'")
    return pairs.select("feature", F.col("target").alias("base"), F.lit("X (lag/derivado)").alias("role"))
