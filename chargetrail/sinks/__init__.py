"""Writers for lake tables, and catalog definitions."""

from chargetrail.sinks.catalog import create_database, create_external_table, sanitised_name
from chargetrail.sinks.files import write_parquet, write_partitioned, write_routed, write_slice

__all__ = [
    "create_database",
    "create_external_table",
    "sanitised_name",
    "write_parquet",
    "write_partitioned",
    "write_routed",
    "write_slice",
]
