"""Sources and sinks: typed table reads, single-file or parallel CSV export, and the
report inputs derived from the driver tables."""

from dialstat.sources.export import write_result
from dialstat.sources.tables import CALLS_COLUMNS, PEOPLE_COLUMNS, SALES_COLUMNS, InputError, read_table

__all__ = [
    "CALLS_COLUMNS",
    "InputError",
    "PEOPLE_COLUMNS",
    "SALES_COLUMNS",
    "read_table",
    "write_result",
]
