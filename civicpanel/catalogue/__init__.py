"""The query catalogue; importing it registers every query."""

from civicpanel.catalogue import (  # noqa: F401
    aggregate_queries,
    report_queries,
    panel_queries,
    briefing_queries,
    source_queries,
    territory_queries,
)
from civicpanel.catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
