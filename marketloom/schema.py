"""The daily price panel: one row per (date, region, commodity)."""

from __future__ import annotations

from pyspark.sql import types as T

# Header of the source CSV, in file order.
SOURCE_HEADER = (
    "tanggal",
    "kabupaten_kota",
    "kabkot_id",
    "komoditas",
    "harga_rupiah",
    "suhu_rata2_c",
    "curah_hujan_mm",
    "kelembapan_rata2_pct",
    "hari_ke_minggu",
    "bulan",
    "is_akhir_pekan",
    "is_libur_nasional",
    "jarak_ke_idul_fitri_hari",
    "jarak_ke_natal_hari",
)

PANEL_SCHEMA = T.StructType(
    [
        T.StructField("obs_date", T.DateType()),
        T.StructField("region", T.StringType()),
        T.StructField("region_id", T.IntegerType()),
        T.StructField("commodity", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("temp_avg_c", T.DoubleType()),
        T.StructField("rain_mm", T.DoubleType()),
        T.StructField("humidity_avg_pct", T.DoubleType()),
        T.StructField("weekday_idx", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("is_weekend", T.IntegerType()),
        T.StructField("is_holiday", T.IntegerType()),
        T.StructField("days_to_eid", T.IntegerType()),
        T.StructField("days_to_christmas", T.IntegerType()),
    ]
)

PANEL_COLUMNS = PANEL_SCHEMA.fieldNames()
ENTITY = ["region", "commodity"]
SERIES_DAY = ["commodity", "obs_date"]
PRICE = "price"
WEATHER = ["temp_avg_c", "rain_mm", "humidity_avg_pct"]
CALENDAR = [
    "weekday_idx",
    "month",
    "is_weekend",
    "is_holiday",
    "days_to_eid",
    "days_to_christmas",
]

# What a forecast sees of each day.
MODEL_INPUTS = [PRICE, *WEATHER, *CALENDAR]

# What the anomaly forest sees of each row.
ANOMALY_FEATURES = [
    PRICE,
    "deviation_pct",
    "delta_pct",
    *WEATHER,
    "is_weekend",
    "is_holiday",
    "days_to_eid",
    "days_to_christmas",
]

# The defaults of the monitored system.
HORIZON = 7
SEQUENCE_DAYS = 30
TEST_RATIO = 0.2
MIN_SAMPLES = 25
HISTORY_DAYS = 60
AVERAGE_DAYS = 7
BACKTEST_DAYS = 20
ANOMALY_RATE = 0.03
N_TREES = 200
SEED = 42
TOP_ANOMALIES = 50
PAGE_ROWS = 10
CRITICAL_SCORE = -0.05
RESULT_VERSION = 2
