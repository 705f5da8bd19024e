"""The engine's operators as queries over the driver's tables, each with the SQL that must give the same rows."""

from stratum.queries.frames import FRAME_QUERIES, medallion_sales
from stratum.queries.oracles import ORACLES
from stratum.queries.stored import STORED_QUERIES

QUERIES = {**FRAME_QUERIES, **STORED_QUERIES}

__all__ = ["ORACLES", "QUERIES", "medallion_sales"]
