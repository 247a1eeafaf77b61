"""All registered queries (imports register them)."""

from notelab.plans import (  # noqa: F401
    catalog_basic, catalog_corpus, catalog_eval, catalog_measures, catalog_more, catalog_rx, catalog_sections, catalog_similarity,
    catalog_sources, catalog_spans, catalog_surface)
from notelab.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
