"""All registered queries by name."""

from __future__ import annotations

from . import sales_queries, scale_queries, stat_queries, table_queries, text_queries
from .query import Query

# A report read back from JSON is the summary it was made from.
QUERIES: dict[str, Query] = {
    **text_queries.QUERIES,
    **sales_queries.QUERIES,
    **stat_queries.QUERIES,
    **table_queries.QUERIES,
    **scale_queries.QUERIES,
    "json_report": table_queries.QUERIES["json_report"]._replace(
        sql=text_queries.QUERIES["sentiment_summary"].sql
    ),
}
