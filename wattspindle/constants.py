"""Values shared by the layers. Everything here is a plain parameter."""

# Signal and window geometry.
SAMPLE_RATE_HZ = 2000
CHUNK_SAMPLES = 1000
WINDOW_MINUTES = 15
WINDOW = "15 minutes"
SLIDE = "5 minutes"
WATERMARK = "10 minutes"

# Fleet naming.
OPERATIONS = [f"OP{i:02d}" for i in range(15)]

# Risk thresholds, highest first. Daily classes need a rate
# strictly above the bound, period classes a rate at or above it.
DAILY_RATE_BOUNDS = [(20.0, "CRITICAL"), (10.0, "HIGH_RISK"), (5.0, "MEDIUM_RISK")]
PERIOD_RATE_BOUNDS = [(40.0, "CRITICAL"), (25.0, "HIGH_RISK"), (10.0, "MEDIUM_RISK")]
LOWEST_RISK = "LOW_RISK"

# Vibration stability classes against the fleet-wide percentiles.
STABILITY_PERCENTILES = {"p50": 0.50, "p75": 0.75}

# Country code to bidding-zone identifier.
ZONE_CODES = {
    "DE": "10Y1001A1001A63L",
    "DE-LU": "10Y1001A1001A82H",
    "FR": "10YFR-RTE------C",
}
ZONE_ALIASES = {"DE": "DE-LU"}
MARKET_TIMEZONE = "Europe/Berlin"

# Stand-in price for hours without a quote.
FALLBACK_PRICE = 50.0
FALLBACK_SOURCE = "MOCK"
INDEX_UNIT = "Index (2015=100)"

EXPECTED_YEARS = (2019, 2021)

# A lookup side is broadcast only when a measurement shows that it takes at most this
# much memory.
BROADCAST_BYTES = 64 << 20
