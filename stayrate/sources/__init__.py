from stayrate.sources.tables import SCHEMAS, load_csv_checked, load_tables, parse_dates, read_driver_table
from stayrate.sources.sinks import read_versioned, write_results, write_versioned
from stayrate.sources.fixtures import Fixture, fixture, oracle_with, AS_OF

__all__ = ["SCHEMAS", "load_tables", "parse_dates", "read_driver_table", "write_results",
           "Fixture", "fixture", "oracle_with", "AS_OF"]
