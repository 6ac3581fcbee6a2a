"""Changes of the instrument universe between what is stored and a snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DELISTED = "DELISTED"
_STATE = ["base_asset", "quote_asset", "status", "is_spot_trading_allowed", "is_margin_trading_allowed", "base_asset_precision", "quote_asset_precision"]


def universe_diff(existing: DataFrame, snapshot: DataFrame, quote_asset: str = "USDT") -> DataFrame:
    """A row for every symbol that has to be written: its new state, change, and whether that is an event.

    change is new, transition (status or spot trading differ), unchanged (written again, no event) or delisted (stored
    under the quote asset, not in the snapshot, not delisted yet: no spot trading, margin as it was). Symbols that are
    delisted already, or of another quote asset, are left alone.
    """
    quote = quote_asset.strip().upper()
    named = lambda df: df.withColumns({"symbol": F.upper(F.trim("symbol")), "quote_asset": F.upper(F.trim("quote_asset"))})
    now = named(snapshot).filter(F.col("quote_asset") == quote).select("symbol", F.struct(*_STATE).alias("now"))
    then = named(existing).select("symbol", F.struct(*_STATE).alias("then"))
    both = then.join(now, "symbol", "full_outer")
    differs = ~(F.col("then.status").eqNullSafe(F.col("now.status")) & F.col("then.is_spot_trading_allowed").eqNullSafe(F.col("now.is_spot_trading_allowed")))
    gone = F.col("now").isNull() & (F.col("then.quote_asset") == quote) & (F.col("then.status") != DELISTED)
    change = F.when(F.col("now").isNotNull(), F.when(F.col("then").isNull(), "new").when(differs, "transition").otherwise("unchanged")).when(gone, "delisted")
    delisted = F.col("then").withField("status", F.lit(DELISTED)).withField("is_spot_trading_allowed", F.lit(False))
    state = F.when(F.col("now").isNotNull(), F.col("now")).otherwise(delisted)
    found = both.select("symbol", change.alias("change"), state.alias("s")).filter(F.col("change").isNotNull())
    return found.select("symbol", "s.*", "change", (F.col("change") != "unchanged").alias("is_event"))
