"""Machine-telemetry, energy-price and production-index analytics on Spark."""

__version__ = "0.1.0"
