"""Fixed domain values.

These must equal the values the original pipeline uses for its results to be
reproduced; they are stated here plainly, together, in their natural order.
"""

# --- fixed values -----------------------------------------------------------
# Target pollutants kept by staging (six codes).
TARGET_POLLUTANTS = ("pm25", "pm10", "no2", "co", "o3", "so2")

# Molecular weights in g/mol per pollutant; particulates have none (NULL).
MOLECULAR_WEIGHTS = (
    ("no2", 46.0055),
    ("o3", 48.00),
    ("so2", 64.066),
    ("co", 28.01),
    ("pm25", None),
    ("pm10", None),
)

# Molar volume of an ideal gas at 25 °C and 1 atm, litres per mole.
MOLAR_VOLUME = 24.45
# ppm -> ppb factor.
PPM_TO_PPB = 1000

# Raw readings at or above this value are sensor over-range placeholders.
OVER_RANGE = 10000.0
# Minimum hourly completeness (percent, 0-100) for a valid daily value.
MIN_PERCENT_COMPLETE = 75.0
# Per-unit plausibility caps on the raw value.
UNIT_CAPS = (("ppm", 50.0), ("ppb", 50000.0))

# WHO 24-hour PM2.5 alert threshold, µg/m³ (strictly greater than).
WHO_PM25_24H = 25.0

# Unit label written on every cleaned reading.
CLEAN_UNIT = "ug/m3"

# Half width of the box around a capital, degrees.
BBOX_HALF_WIDTH = 0.3
# A station is active when it reported within this many days.
ACTIVE_WITHIN_DAYS = 30
# Default ingestion window, days.
WINDOW_DAYS = 730
# Stations returned per capital by one page of the station search.
LOCATIONS_PAGE_SIZE = 1000

# Dashboard scales: colour cap quantile, axis quantile and headroom,
# marker size range, top-N bars.
COLOUR_QUANTILE = 0.95
AXIS_QUANTILE = 0.98
AXIS_HEADROOM = 1.05
MARKER_MIN = 4
MARKER_SPAN = 26
TOP_N_BARS = 15
TOP_N_RANKED = 10
# --- end of fixed values ----------------------------------------------------
