"""Report compositions (R1-R6), the report job (B1) and the driver's query catalogue."""

from dialstat.plans.job import ReportsError, load_inputs, run_report, run_reports
from dialstat.plans.reports import (
    REPORTS,
    Report,
    best_seller_by_country,
    format_breakdown,
    postcodes,
    segment_breakdown,
    segment_top_k,
    top_performers,
    top_products_in_country,
    with_success_rate,
)

__all__ = [
    "REPORTS",
    "Report",
    "ReportsError",
    "best_seller_by_country",
    "format_breakdown",
    "load_inputs",
    "postcodes",
    "run_report",
    "run_reports",
    "segment_breakdown",
    "segment_top_k",
    "top_performers",
    "top_products_in_country",
    "with_success_rate",
]
