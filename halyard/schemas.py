"""Schemas of the tables that are landed or kept."""

from __future__ import annotations

from halyard.registry import COLUMN

SOURCE_VALUES = """
spot_id string, source_code string, valid_time timestamp, metric string, value double, unit string, fetched_at timestamp,
raw_variable string, run_id string, model string, resolution_minutes int, grid_lat double, grid_lon double, quality_flags map<string,string>
"""
FORECAST_COLUMNS = tuple(COLUMN.values())
RULE = """
rule_key string, rule_type string, title string, description string, legal_reference string, metric_type string, metric_value double,
metric_unit string, species_common_name string, species_scientific_name string, notes string, source_excerpt string,
source_context string, needs_manual_review boolean, valid_from date, valid_to date, quality_flags array<string>,
source struct<source_type:string,source_priority:int,authority_name:string,source_url:string,title:string,effective_date:string,fetched_at:string>,
zone struct<zone_code:string,zone_name:string,strategy:string,lat_min:double,lat_max:double,lon_min:double,lon_max:double>
"""
SOURCES = "source_id string, source_type string, source_priority int, authority_name string, title string, url string, kind string"
EXPECTATIONS = "id string, label string, severity string, any_of array<map<string,string>>"
