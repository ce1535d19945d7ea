"""Seed rows of the small dimensions.

These are fixed values: the verdicts depend on them, so they must equal the
seeded tables of the traffic pipeline being re-expressed. One Python list per
table is the single source for the Spark DataFrame and for the SQL ``VALUES``
text used by the oracle.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the seeded dimension tables)
# ---------------------------------------------------------------------------

# intersection_id, intersection_name, latitude, longitude, description
INTERSECTIONS = [
    (1, "Ngã tư Xuân Đỉnh", 21.0664, 105.7815, "Phạm Văn Đồng - Xuân Đỉnh"),
    (2, "Ngã tư Cổ Nhuế", 21.0562, 105.7823, "Phạm Văn Đồng - Cổ Nhuế"),
    (3, "Ngã tư Hoàng Quốc Việt", 21.0458, 105.7831, "Phạm Văn Đồng - Hoàng Quốc Việt"),
    (4, "Ngã tư Mai Dịch", 21.0368, 105.7795, "Phạm Văn Đồng - Mai Dịch"),
    (5, "Khu vực Xuân Đỉnh thực", 21.0834, 105.7808, "Điểm thu thập thực tế từ app"),
]

# traffic_light_id, intersection_id, intersection_name, latitude, longitude,
# direction_degree, default_green, default_yellow, default_red, is_adaptive
TRAFFIC_LIGHTS = [
    ("TL001", 1, "Ngã tư Xuân Đỉnh", 21.0664, 105.7815, 180, 45, 3, 60, False),
    ("TL002", 2, "Ngã tư Cổ Nhuế", 21.0562, 105.7823, 180, 40, 3, 55, False),
    ("TL003", 3, "Ngã tư Hoàng Quốc Việt", 21.0458, 105.7831, 180, 50, 3, 65, False),
    ("TL004", 4, "Ngã tư Mai Dịch", 21.0368, 105.7795, 180, 45, 3, 60, False),
    ("TL005", 5, "Khu vực Xuân Đỉnh thực", 21.0834, 105.7808, 180, 45, 3, 60, False),
]

# traffic_light_id, start_time, end_time, green, yellow, red, applicable_days
LIGHT_SCHEDULE = [
    ("TL001", "06:00", "09:00", 45, 3, 60, "weekday"),
    ("TL001", "09:00", "16:00", 35, 3, 45, "weekday"),
    ("TL001", "16:00", "20:00", 50, 3, 65, "weekday"),
    ("TL001", "20:00", "06:00", 30, 3, 40, "weekday"),
    ("TL002", "06:00", "09:00", 40, 3, 55, "weekday"),
    ("TL002", "09:00", "16:00", 30, 3, 40, "weekday"),
    ("TL002", "16:00", "20:00", 45, 3, 60, "weekday"),
    ("TL002", "20:00", "06:00", 25, 3, 35, "weekday"),
    ("TL003", "06:00", "09:00", 50, 3, 65, "weekday"),
    ("TL003", "09:00", "16:00", 40, 3, 50, "weekday"),
    ("TL003", "16:00", "20:00", 55, 3, 70, "weekday"),
    ("TL003", "20:00", "06:00", 35, 3, 45, "weekday"),
    ("TL004", "06:00", "09:00", 45, 3, 60, "weekday"),
    ("TL004", "09:00", "16:00", 35, 3, 45, "weekday"),
    ("TL004", "16:00", "20:00", 50, 3, 65, "weekday"),
    ("TL004", "20:00", "06:00", 30, 3, 40, "weekday"),
    ("TL005", "06:00", "09:00", 45, 3, 60, "weekday"),
    ("TL005", "09:00", "16:00", 35, 3, 45, "weekday"),
    ("TL005", "16:00", "20:00", 50, 3, 65, "weekday"),
    ("TL005", "20:00", "06:00", 30, 3, 40, "weekday"),
    ("TL005", "06:00", "20:00", 40, 3, 50, "weekend"),
    ("TL005", "20:00", "06:00", 25, 3, 35, "weekend"),
]

# Congestion thresholds (km/h) and labels.
SPEED_CONGESTED_KMH = 10.0
SPEED_SLOW_KMH = 25.0
LABEL_CONGESTED = "Tắc nghẽn"
LABEL_SLOW = "Chậm"
LABEL_FREE = "Thông thoáng"

# Hours counted as peak hour, and the generated time dimension's range.
PEAK_HOURS = (6, 7, 8, 16, 17, 18, 19)
TIME_DIM_START = "2025-01-01 00:00:00"
TIME_DIM_END = "2027-12-31 23:00:00"
TIME_DIM_HOURS = 26280

# ---------------------------------------------------------------------------


def hhmm_to_sec(s: str) -> int:
    h, m = s.split(":")
    return int(h) * 3600 + int(m) * 60


def schedule_rows():
    """Schedule seed with SERIAL ids in insertion order and TIME as seconds."""
    return [
        (i + 1, light, hhmm_to_sec(st), hhmm_to_sec(en), g, y, r, days, "fixed")
        for i, (light, st, en, g, y, r, days) in enumerate(LIGHT_SCHEDULE)
    ]


def _sql_lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    return "'" + str(v).replace("'", "''") + "'"


def sql_values(rows, columns) -> str:
    """``(VALUES ...) AS t(cols)`` text for an inline table."""
    body = ",\n    ".join("(" + ", ".join(_sql_lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES\n    {body}\n) AS t({', '.join(columns)})"
