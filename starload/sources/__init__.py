"""Sources and sinks: parquet/catalog tables, JDBC, JSON, warehouse appends."""

from starload.sources.jdbc import jdbc_options, read_jdbc
from starload.sources.json_io import read_json, to_json_column, write_json
from starload.sources.tables import TEST_TABLES, read_table, read_tables, register_views
from starload.sources.warehouse import (append_by_name, append_new_only, read_back, table_exists, try_read_back,
                                        write_table)

__all__ = [n for n in dir() if not n.startswith("_")]
