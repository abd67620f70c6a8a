"""All registered queries of the library, and the SQL they are held against."""

from . import raster_queries, record_queries, tile_queries
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "raster_queries", "record_queries", "tile_queries"]
