"""All registered queries: importing the catalog modules fills ``QUERIES``."""

from loanlens.plans import (catalog, catalog_credit, catalog_functions, catalog_maintain,  # noqa: F401
                            catalog_models, catalog_sources, catalog_streaming)
from loanlens.plans.catalog import QUERIES

__all__ = ["QUERIES"]
