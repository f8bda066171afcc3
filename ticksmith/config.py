"""Fixed values and window-job presets.

Widths, watermark delays, keys and connection settings are parameters
everywhere in the library; the presets below only reproduce the three
aggregate jobs of the original tick application.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values (must equal the original application's) -------------------
# Symbols polled by the original producer, in its order, and the single
# target currency every quote is converted to.
SYMBOLS = ("BTC", "ETH", "XRP", "BNB", "SOL", "DOGE", "TRX", "ADA")
TARGET_CURRENCY = "EUR"
# Message key = <symbol> + "_" + <target>, e.g. "BTC_EUR".
KEY_SEPARATOR = "_"
# The only escaping applied to a symbol before it goes into a request URL.
URL_SPACE = (" ", "%20")
# Dashboard default: relative time range.
DEFAULT_LOOKBACK = "3 hours"
# Sink column limit: from_currency / to_currency are varchar(10).
CURRENCY_MAX_LEN = 10
# -----------------------------------------------------------------------------

# Aggregate layouts: output column -> aggregate function over the tick value.
PRICE = {"rate": "avg"}
HLA = {"high_rate": "max", "low_rate": "min", "avg_rate": "avg"}

# Tick key columns and their names in the windowed tables.
TICK_KEYS = {"from": "from_currency", "to": "to_currency"}


@dataclass(frozen=True)
class WindowSpec:
    """One tumbling-window aggregate job.

    ``width`` and ``delay`` are Spark interval strings ("5 minutes").
    ``aggs`` maps output column -> "avg" | "max" | "min" | "sum" | "count".
    ``table`` names the sink table the job writes to.
    """

    name: str
    width: str
    delay: str
    aggs: dict = field(default_factory=lambda: dict(HLA))
    table: str = ""

    @property
    def sink_table(self) -> str:
        return self.table or f"rate_{self.name}"


# The three jobs of the original application: watermark delay = width.
DEFAULT_JOBS = (
    WindowSpec("1min", "1 minute", "1 minute", dict(PRICE), "rate_1min"),
    WindowSpec("5min", "5 minutes", "5 minutes", dict(HLA), "rate_5min"),
    WindowSpec("10min", "10 minutes", "10 minutes", dict(HLA), "rate_10min"),
)
