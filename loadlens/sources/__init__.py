"""Scans: landed tables, registry, readings, payload files."""

from loadlens.sources.tables import load_table  # noqa: F401
from loadlens.sources.readings import (  # noqa: F401
    read_provider_tables, readings_from_events, readings_in_range, union_providers,
)
from loadlens.sources.registry import read_registry_jdbc, registry_from_customer  # noqa: F401
