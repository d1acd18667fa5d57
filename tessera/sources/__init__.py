from tessera.sources.files import (
    GAME_SALES_SCHEMA,
    read_game_sales,
    typed_year,
    literal_rows,
    read_csv,
    read_text_by_language,
    read_text_lines,
    write_csv,
)
from tessera.sources.tables import TABLE_NAMES, Tables, read_table, table_path

__all__ = [
    "GAME_SALES_SCHEMA",
    "read_game_sales",
    "typed_year",
    "TABLE_NAMES",
    "Tables",
    "literal_rows",
    "read_csv",
    "read_table",
    "read_text_by_language",
    "read_text_lines",
    "table_path",
    "write_csv",
]
