"""Input contracts and loaders."""

from .catalog_tables import CatalogTables
from .contracts import CONTRACTS, CheckedRead, ContractError, ContractReport, conform, conform_checked
from .driver_tables import DriverTables

__all__ = ["CONTRACTS", "CatalogTables", "CheckedRead", "ContractError", "ContractReport", "conform", "conform_checked",
           "DriverTables"]
