"""All registered queries: name -> (Spark query, DuckDB SQL or None)."""

from driver.reports import REPORT_QUERIES
from driver.traces import TRACE_QUERIES

CATALOG = {**REPORT_QUERIES, **TRACE_QUERIES}
