"""Views, reports, forecasts and the load run."""
