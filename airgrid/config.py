"""Vocabulary, valid ranges and index tables.

Everything here is configuration: the operators take these values as
arguments and only default to them.
"""

from __future__ import annotations

# Variable vocabulary, valid ranges, sensor codes, file stems.
POLLUTANTS = ("PM25", "PM10", "O3", "CO", "NO2", "SO2")
WEATHER = (
    "Temperatura",
    "Humedad",
    "Viento_Velocidad",
    "Viento_Direccion",
    "Precipitacion",
)
VARIABLES = POLLUTANTS + WEATHER
MAX_MISSING_VARIABLES = 1

VALID_RANGES = {
    "PM25": (0.0, 400.0),
    "PM10": (0.0, 999.0),
    "O3": (0.0, 500.0),
    "CO": (0.0, 50.0),
    "NO2": (0.0, 500.0),
    "SO2": (0.0, 500.0),
    "Temperatura": (-10.0, 50.0),
    "Humedad": (0.0, 100.0),
    "Viento_Velocidad": (0.0, 50.0),
    "Viento_Direccion": (0.0, 360.0),
    "Precipitacion": (0.0, 200.0),
}
SENSOR_CODES = (-999.0, -9999.0, 9999.0)

FILE_NAMES = {
    "PM25": ("PM2.5.xlsx", "PM25.xlsx", "PM25.csv"),
    "PM10": ("PM10.xlsx", "PM10.csv"),
    "O3": ("O3.xlsx", "O3.csv"),
    "CO": ("CO.xlsx", "CO.csv"),
    "NO2": ("NO2.xlsx", "NO2.csv"),
    "SO2": ("SO2.xlsx", "SO2.csv"),
    "Temperatura": ("TMP.xlsx", "Temperatura.xlsx", "Temperatura.csv"),
    "Humedad": ("HUM.xlsx", "Humedad.xlsx", "Humedad.csv"),
    "Viento_Velocidad": ("VEL.xlsx", "Viento_Velocidad.xlsx"),
    "Viento_Direccion": ("DIR.xlsx", "Viento_Direccion.xlsx"),
    "Precipitacion": ("LLU.xlsx", "Precipitacion.xlsx"),
}
# Readable files, unit rows, columns that are no stations, names of time and control columns.
FILE_EXTENSIONS = ("xlsx", "xls", "csv")
UNIT_ROW_PATTERN = "unidad|unit|ug|mg|%|m/s|°|grados"
NOT_STATIONS = ("FECHA", "DATE")
TIME_WORDS = ("time", "fecha", "date", "hora", "datetime", "timestamp")
CONTROL_COLUMNS = (
    "Fecha", "fecha", "Parroquia", "parroquia", "Date", "date",
    "Timestamp", "timestamp", "Time", "time", "DateTime", "datetime",
)

# Names of coordinate columns.
LATITUDES = ("lat", "latitud", "latitude")
LONGITUDES = ("lon", "lng", "longitud", "longitude")

# Cleaning and training defaults (fixed values).
TARGET = "PM25"
EXCLUDED_START = "2020-01-01"
EXCLUDED_END = "2021-12-31"
EXCLUDED_YEARS = (2020, 2021)
GAP_HOURS = 24
TARGET_LAGS = (1, 3, 24)
MEAN_WINDOWS = (3, 6, 12, 24)
STD_WINDOWS = (6, 12, 24)
DIFF_LAGS = (1, 3, 6, 12, 24)
TRAIN_RATIO = 0.8
INNER_RATIO = 0.8
FOLDS = 5
TOP_FEATURES = 40
PLOT_DAYS = 7
PATIENCE = 50
CURVE_BATCH = 20
SAMPLE_ROWS = 5000
SEED = 42
EXTRAPOLATION_WARN_HOURS = 48
OVERFIT_GAP = 0.15

# The strict schema check lists these features first, in this order.
BASE_FEATURES = (
    "Temperatura", "Humedad", "Viento_Velocidad", "Viento_Direccion", "Precipitacion",
    "hora_sin", "hora_cos", "mes_sin", "mes_cos",
    "PM25_lag_1h", "PM25_lag_24h", "PM10_lag_1h", "PM10_lag_24h", "O3_lag_1h", "O3_lag_24h",
    "CO_lag_1h", "CO_lag_24h", "NO2_lag_1h", "NO2_lag_24h", "SO2_lag_1h", "SO2_lag_24h",
)

# Index segments (c_lo, c_hi, i_lo, i_hi), both ends closed.
INDEX_SEGMENTS = {
    "PM25": (
        (0.0, 12.0, 0, 50), (12.1, 37.4, 51, 100), (37.5, 55.4, 101, 150),
        (55.5, 150.4, 151, 200), (150.5, 250.4, 201, 300), (250.5, 500.4, 301, 500),
    ),
    "PM10": (
        (0.0, 54.0, 0, 50), (55.0, 154.0, 51, 100), (155.0, 254.0, 101, 150),
        (255.0, 354.0, 151, 200), (355.0, 424.0, 201, 300), (425.0, 604.0, 301, 500),
    ),
    "O3": (
        (0.0, 54.0, 0, 50), (55.0, 124.0, 51, 100), (125.0, 164.0, 101, 150),
        (165.0, 204.0, 151, 200), (205.0, 404.0, 201, 300), (405.0, 604.0, 301, 500),
    ),
    "CO": (
        (0.0, 4.4, 0, 50), (4.5, 9.4, 51, 100), (9.5, 12.4, 101, 150),
        (12.5, 15.4, 151, 200), (15.5, 30.4, 201, 300), (30.5, 50.4, 301, 500),
    ),
    "NO2": (
        (0.0, 53.0, 0, 50), (54.0, 100.0, 51, 100), (101.0, 360.0, 101, 150),
        (361.0, 649.0, 151, 200), (650.0, 1249.0, 201, 300), (1250.0, 2049.0, 301, 500),
    ),
    "SO2": (
        (0.0, 35.0, 0, 50), (36.0, 75.0, 51, 100), (76.0, 185.0, 101, 150),
        (186.0, 304.0, 151, 200), (305.0, 604.0, 201, 300), (605.0, 1004.0, 301, 500),
    ),
}
# Index categories (lo, hi, label, colour), both ends closed.
INDEX_CATEGORIES = (
    (0, 50, "Deseable", "#10B981"),
    (51, 100, "Aceptable", "#EAB308"),
    (101, 150, "Precaución", "#F97316"),
    (151, 200, "Alerta", "#EF4444"),
    (201, 300, "Alarma", "#A855F7"),
    (301, 500, "Emergencia", "#111827"),
)
INDEX_CEILING = 500.0

# Upper bounds (c_hi, i_hi) of the hole-free index; above -> 500.
CONTINUOUS_BOUNDS = {
    "PM25": ((15.0, 50), (25.0, 100), (37.5, 150), (50.0, 200)),
    "PM10": ((25.0, 50), (50.0, 100), (75.0, 150), (100.0, 200)),
    "O3": ((54.0, 50), (70.0, 100), (85.0, 150), (105.0, 200)),
    "CO": ((4.4, 50), (9.4, 100), (12.4, 150), (15.4, 200)),
    "NO2": ((53.0, 50), (100.0, 100), (360.0, 150), (649.0, 200)),
    "SO2": ((35.0, 50), (75.0, 100), (185.0, 150), (304.0, 200)),
}
# Categories of the hole-free index, first bound with index <= bound.
CONTINUOUS_CATEGORIES = (
    (50, "🟢 Deseable"),
    (100, "🟡 Aceptable"),
    (150, "🟠 Precaución"),
    (200, "🔴 Alerta"),
    (300, "🟣 Alarma"),
    (None, "🟤 Emergencia"),
)

# Label ladders, first bound with c <= bound (None = no bound).
AQI_LABELS = {
    "PM25": ((12, "🟢 Buena"), (35, "🟡 Moderada"), (55, "🟠 Insalubre GS"),
             (150, "🔴 Insalubre"), (None, "🟣 Muy insalubre")),
    "PM10": ((54, "🟢 Buena"), (154, "🟡 Moderada"), (254, "🟠 Insalubre GS"),
             (None, "🔴 Insalubre")),
    "O3": ((54, "🟢 Buena"), (70, "🟡 Moderada"), (85, "🟠 Insalubre GS"),
           (None, "🔴 Insalubre")),
    "CO": ((9.4, "🟢 Buena"), (12.4, "🟡 Moderada"), (None, "🔴 Insalubre")),
    "NO2": ((53, "🟢 Buena"), (100, "🟡 Moderada"), (360, "🟠 Insalubre GS"),
            (None, "🔴 Insalubre")),
    "SO2": ((35, "🟢 Buena"), (75, "🟡 Moderada"), (185, "🟠 Insalubre GS"),
            (None, "🔴 Insalubre")),
}
AQI_UNKNOWN = "⚪ N/D"
AQI_ICONS = {
    "PM25": ((12, "🟢"), (35, "🟡"), (55, "🟠"), (150, "🔴"), (None, "🟣")),
    "PM10": ((54, "🟢"), (154, "🟡"), (254, "🟠"), (354, "🔴"), (None, "🟣")),
    "O3": ((54, "🟢"), (70, "🟡"), (85, "🟠"), (105, "🔴"), (None, "🟣")),
    "NO2": ((53, "🟢"), (100, "🟡"), (360, "🟠"), (649, "🔴"), (None, "🟣")),
    "CO": ((4.4, "🟢"), (9.4, "🟡"), (12.4, "🟠"), (15.4, "🔴"), (None, "🟣")),
    "SO2": ((35, "🟢"), (75, "🟡"), (185, "🟠"), (304, "🔴"), (None, "🟣")),
}
ICON_UNKNOWN = "⚪"
PM25_QUALITY = (
    (12, "🟢 Buena"),
    (35, "🟡 Moderada"),
    (55, "🟠 Insalubre GS"),
    (150, "🔴 Insalubre"),
    (None, "🟣 Muy insalubre"),
)
# Units.
UNITS = {"CO": "mg/m³"}
DEFAULT_UNIT = "µg/m³"

# Score bands.
R2_GOOD = 0.7
R2_ACCEPTABLE = 0.5
R2_EXCELLENT = 0.9
