"""Explicit read schemas and the column lists of stored tables."""

from __future__ import annotations

# Source file columns.
INCIDENT_COLUMNS = {
    "Area Unit": "area_unit",
    "Territorial Authority": "territorial_authority",
    "Meshblock": "meshblock",
    "Year Month": "year_month",
    "ANZSOC Division": "division",
    "ANZSOC Group": "anzsoc_group",
}
CONCORDANCE_COLUMNS = [
    "AU2017_name", "SA22023_code", "SA22023_name", "SA22023_name_ascii", "REGC2023_name", "TA2023_name",
    "MB2023_code", "MB2013_code", "UR2023_name",
]
CENSUS_COLUMNS = {"Area": "area", "Census year": "census_year", "Value": "value"}

CENSUS = "area string, census_year int, value bigint, row_no string"
METRIC = "timestamp string, metric_name string, value double, unit string, context map<string,string>"

INCIDENT = [
    "event_id", "suburb_id", "victimisation_date", "offence_code", "offence_category", "offence_description",
    "meshblock_code", "AU2017_name",
]
AREA_SUMMARY = [
    "suburb_id", "slug", "name", "region", "council", "lat", "lng", "safety_score", "crime_rate_per_1000",
    "crime_trend", "total_crimes_12m", "report_url", "geometry",
]
AREA_DETAIL = AREA_SUMMARY[:-1] + [
    "rank_in_region", "crime_breakdown", "trend_3m_change", "population", "nearby_suburbs", "peak_crime_months", "geometry",
]
# response models leave the report address out
SUMMARY_MODEL = [c for c in AREA_SUMMARY if c != "report_url"]
DETAIL_MODEL = [c for c in AREA_DETAIL if c != "report_url"]
EVENT_MODEL = [
    "event_id", "suburb_id", "offence_code", "offence_description", "offence_category", "victimisation_date", "meshblock_code",
]
AREA = [
    "suburb_id", "AU2017_name", "name", "slug", "region", "council", "location_type", "lat", "lng", "geometry",
    "safety_score", "crime_rate_per_1000", "total_crimes_12m", "crime_trend", "rank_in_region", "crime_breakdown",
    "trend_3m_change", "peak_crime_months", "report_url", "widget_embed_code", "summary_text", "tags", "population",
    "nearby_suburbs",
]
BLOCK = ["id", "suburb_id", "crime_count", "lat", "lng", "geometry"]
NEIGHBOURS = "array<struct<suburb_id:string,slug:string,name:string,region:string,distance_km:double>>"
