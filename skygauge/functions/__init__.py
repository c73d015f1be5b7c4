"""Column expressions: each takes columns and returns a column."""

from skygauge.functions.scoring import iqr_outlier, severity, z_score
from skygauge.functions.text import city_part, is_json, slugify, uf_part, url_encode
from skygauge.functions.times import (
    date_string,
    event_time,
    file_name_time,
    landing_time,
    partition_dates,
    time_string,
    to_day,
)

__all__ = [
    "city_part", "date_string", "event_time", "file_name_time", "iqr_outlier",
    "is_json", "landing_time", "partition_dates", "severity", "slugify",
    "time_string", "to_day", "uf_part", "url_encode", "z_score",
]
