"""Declared tables, data sets and the curated list of demographic measures.

One set of objects drives writers and readers, so that a column cannot be
written under one name and declared under another.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import DoubleType, StringType, StructField, StructType, TimestampNTZType

# Column names of the declared tables.
REQUEST_COLUMNS = """
unique_key created_date closed_date agency agency_name complaint_type descriptor location_type
incident_zip incident_address street_name cross_street_1 cross_street_2 intersection_street_1
intersection_street_2 address_type city landmark facility_type status due_date
resolution_description resolution_action_updated_date community_board bbl borough
x_coordinate_state_plane y_coordinate_state_plane open_data_channel_type park_facility_name
park_borough vehicle_type taxi_company_borough taxi_pick_up_location bridge_highway_name
bridge_highway_direction road_ramp bridge_highway_segment latitude longitude location_latitude
location_longitude
""".split()

COLLISION_COLUMNS = """
collision_id crash_date crash_time borough zip_code latitude longitude location_latitude
location_longitude on_street_name cross_street_name off_street_name number_of_persons_injured
number_of_persons_killed number_of_pedestrians_injured number_of_pedestrians_killed
number_of_cyclist_injured number_of_cyclist_killed number_of_motorist_injured
number_of_motorist_killed contributing_factor_vehicle_1 contributing_factor_vehicle_2
contributing_factor_vehicle_3 contributing_factor_vehicle_4 contributing_factor_vehicle_5
vehicle_type_code1 vehicle_type_code2 vehicle_type_code_3 vehicle_type_code_4 vehicle_type_code_5
""".split()

RIDERSHIP_TEXT_COLUMNS = """
transit_mode station_complex_id station_complex borough payment_method fare_class_category
""".split()

RIDERSHIP_FLOAT_COLUMNS = "ridership transfers latitude longitude".split()

ZONE_COLUMNS = "objectid shape_leng the_geom shape_area zone locationid borough geometry_wkt".split()

TRACT_COLUMNS = """
boroct2020 ct2020 boroname borocode ctlabel nta2020 ntaname cdta2020 cdtaname geoid shape_leng
shape_area geometry_wkt
""".split()

CROSSWALK_COLUMNS = "zone_id zone borough tract_geoid ntaname".split()

# Census variable code -> measure name.
MEASURES = {
    "B01003_001E": "total_pop",
    "B01002_001E": "median_age",
    "B19013_001E": "median_household_income",
    "B17001_001E": "poverty_universe",
    "B17001_002E": "poverty_below",
    "B02001_002E": "race_white_alone",
    "B02001_003E": "race_black_alone",
    "B02001_005E": "race_asian_alone",
    "B03003_003E": "hispanic_or_latino",
    "B15003_001E": "edu_universe_25plus",
    "B15003_022E": "edu_bachelors",
    "B15003_023E": "edu_masters",
    "B15003_024E": "edu_professional",
    "B15003_025E": "edu_doctorate",
    "B25003_001E": "housing_universe",
    "B25003_002E": "housing_owner_occupied",
    "B25064_001E": "median_gross_rent",
    "B25010_001E": "median_household_size",
    "C16002_001E": "lang_universe",
    "C16002_004E": "lang_lim_eng_spanish",
    "C16002_007E": "lang_lim_eng_other_indo_european",
    "C16002_010E": "lang_lim_eng_asian_pacific_island",
    "C16002_013E": "lang_lim_eng_other",
}

# Area filter, vintages, missing-value threshold, cell resolutions.
STATE = "36"
COUNTIES = ["005", "047", "061", "081", "085"]
VINTAGES = [2018, 2023]
SENTINEL_BELOW = -100_000_000
RESOLUTIONS = (8, 9, 10)

# Rows per landed page, and per part of the ridership table.
PAGE_ROWS = 50_000

PARTITION_COLUMNS = ["year", "month"]


def text_schema(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def cell_columns() -> list[str]:
    return [f"hex_r{r}" for r in RESOLUTIONS]


def requests_schema() -> StructType:
    return text_schema(*REQUEST_COLUMNS, *cell_columns())


def collisions_schema() -> StructType:
    return text_schema(*COLLISION_COLUMNS, *cell_columns())


def ridership_schema() -> StructType:
    return StructType(
        [StructField("transit_timestamp", TimestampNTZType())]
        + [StructField(n, StringType()) for n in RIDERSHIP_TEXT_COLUMNS]
        + [StructField(n, DoubleType()) for n in RIDERSHIP_FLOAT_COLUMNS]
        + [StructField(n, StringType()) for n in cell_columns()]
    )


def zones_schema() -> StructType:
    return text_schema(*ZONE_COLUMNS)


def tracts_schema() -> StructType:
    return text_schema(*TRACT_COLUMNS)


def crosswalk_schema() -> StructType:
    return text_schema(*CROSSWALK_COLUMNS)


def demographics_schema(vintages: list[int] = VINTAGES) -> StructType:
    return text_schema("geoid", *[f"{m}_{v}" for v in vintages for m in MEASURES.values()])


def with_partitions(schema: StructType) -> StructType:
    """The schema followed by the text columns `year` and `month`."""
    return StructType(schema.fields + text_schema(*PARTITION_COLUMNS).fields)


@dataclass(frozen=True)
class Resource:
    """One landed resource of a data set and the years it covers."""

    name: str
    first_year: int
    last_year: int | None = None  # open-ended


@dataclass(frozen=True)
class Dataset:
    """A month-partitioned table and the resources that feed it."""

    table: str
    date_column: str
    key_column: str | None
    resources: tuple[Resource, ...]
    typed: bool = False
    float_columns: tuple[str, ...] = ()
    rows_per_file: int = 0
    text_columns: tuple[str, ...] = field(default=())


# Table names, date and key columns, first and last years.
DATASETS = {
    "requests": Dataset(
        table="nyc_311",
        date_column="created_date",
        key_column="unique_key",
        resources=(Resource("311_legacy", 2010, 2019), Resource("311_current", 2020)),
        text_columns=tuple(REQUEST_COLUMNS),
    ),
    "collisions": Dataset(
        table="nypd_collisions",
        date_column="crash_date",
        key_column="collision_id",
        resources=(Resource("crashes", 2012),),
        text_columns=tuple(COLLISION_COLUMNS),
    ),
    "ridership": Dataset(
        table="mta_turnstile_hourly",
        date_column="transit_timestamp",
        key_column=None,
        resources=(Resource("2020_2024", 2020, 2024), Resource("2025_present", 2025)),
        typed=True,
        float_columns=tuple(RIDERSHIP_FLOAT_COLUMNS),
        rows_per_file=PAGE_ROWS,
        text_columns=tuple(RIDERSHIP_TEXT_COLUMNS),
    ),
}
