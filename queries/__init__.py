"""Registered queries and the SQL each is checked against."""

from queries import daily, forecasting, payload, quality, relational, reporting, stations, streams
from queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "daily", "forecasting", "payload", "quality", "relational", "reporting", "stations",
           "streams"]
