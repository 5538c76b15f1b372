"""Environmental time series on Spark: ingest, star schema, views, quality, forecasts."""

from airlattice.session import build_session, use_checkpoint_dir, use_utc
from airlattice.tables import Warehouse

__all__ = ["Warehouse", "build_session", "use_checkpoint_dir", "use_utc"]
