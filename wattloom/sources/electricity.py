"""Names of the electricity data set.

Fixed values: raw and processed column names, and the entities of each question.
"""

from __future__ import annotations

RAW_TIME = "Datetime__UTC_"

RAW_KEEP = {
    "country_code": "Zone_id",
    "country": "Country",
}

RAW_METRICS = {
    "carbon_intensity": "Carbon_intensity_gCO_eq_kWh__direct_",
    "carbon_free_percentage": "Carbon_free_energy_percentage__CFE__",
}

RAW_DROP = (
    "Carbon_intensity_gCO_eq_kWh__Life_cycle_",
    "Renewable_energy_percentage__RE__",
    "Zone_name",
    "Data_source",
    "Data_estimated",
    "Data_estimation_method",
)

RAW_TYPES = {
    RAW_TIME: "timestamp",
    **{name: "string" for name in RAW_KEEP.values()},
    **{name: "double" for name in RAW_METRICS.values()},
}

READINGS_SCHEMA = (
    "datetime timestamp, country_code string, carbon_intensity double,"
    " carbon_free_percentage double, year int, month int, day int, hour int, country string"
)

TWO_COUNTRIES = ("Italy", "Sweden")

ONE_COUNTRY = "Italy"

THIRTY_COUNTRIES = (
    "Austria", "Belgium", "France", "Finland", "Germany", "Great Britain", "Ireland", "Italy",
    "Norway", "Poland", "Czechia", "Slovenia", "Spain", "Sweden", "Switzerland",
    "USA", "Argentina", "Canada", "Mainland India", "South Korea", "Brazil", "Australia",
    "South Africa", "China", "Mexico", "Morocco", "Thailand", "United Arab Emirates", "Senegal",
    "Singapore",
)

CLUSTER_YEAR = 2024
