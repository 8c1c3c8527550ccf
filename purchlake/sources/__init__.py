from .feeds import FEEDS, Lookups
from .tables import DRIVER_TABLES, Tables, read, table_path

__all__ = ["FEEDS", "Lookups", "DRIVER_TABLES", "Tables", "read", "table_path"]
