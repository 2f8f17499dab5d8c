"""Values of a panel row that a test does not set."""

DEFAULTS = {
    "region": "North",
    "region_id": 1,
    "commodity": "rice",
    "price": 100.0,
    "temp_avg_c": 25.0,
    "rain_mm": 3.0,
    "humidity_avg_pct": 80.0,
    "weekday_idx": 0,
    "month": 1,
    "is_weekend": 0,
    "is_holiday": 0,
    "days_to_eid": 10,
    "days_to_christmas": 20,
}
