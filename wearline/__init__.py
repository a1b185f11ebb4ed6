"""wearline: fleet-health analytics (remaining-life labels, windows, forecasts,
attribution and drift) expressed as Spark DataFrame plans."""

__version__ = "0.1.0"
