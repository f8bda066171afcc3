"""Message keys and request URLs as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticksmith.config import KEY_SEPARATOR, URL_SPACE


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def message_key(symbol="from", target="to") -> Column:
    """``<symbol>_<target>``, e.g. ``BTC_EUR``."""
    return F.concat(_c(symbol), F.lit(KEY_SEPARATOR), _c(target))


def url_escape(col) -> Column:
    """Replace spaces by ``%20`` (the only escaping applied to symbols)."""
    return F.replace(_c(col), F.lit(URL_SPACE[0]), F.lit(URL_SPACE[1]))


def request_url(template: str, symbol="symbol", currency="currency") -> Column:
    """A quote request URL from a ``%s``-template with symbol and currency."""
    return F.format_string(template, url_escape(symbol), url_escape(currency))
