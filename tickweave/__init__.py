"""tickweave: cross-venue candle and spread analytics as Spark jobs.

sources    - trade feeds, landed exchange pages, symbols, request plans, files
functions  - column expressions (time, spread, profit, costs)
operators  - candles, alignment, spread reports, quantiles, rolling windows,
             features, model
plans      - the registered jobs and their SQL oracles
streaming  - candles from a trade stream

The main operators are importable from the package root, e.g.
``from tickweave import ohlc, align, spread, threshold_ladder``.
"""

from .operators.align import align, price_series, widen
from .operators.candles import chunked_candles, dedupe, fill_gaps, ohlc
from .operators.features import engineer
from .operators.quantiles import quantiles
from .operators.rolling import rolling
from .operators.spread import (fee_clearing_summary, histogram, profit_summary, spread,
                               spread_high, threshold_ladder, top_spreads)
from .session import build_session, release
from .sources.chunks import chunk_plan
from .sources.payloads import decode_candles, decode_trades, load_status, read_pages

__version__ = "0.1.0"

__all__ = [
    "align", "build_session", "chunk_plan", "chunked_candles", "decode_candles", "decode_trades",
    "dedupe", "engineer", "fee_clearing_summary", "fill_gaps", "histogram",
    "load_status", "ohlc", "price_series", "profit_summary", "quantiles", "read_pages", "release", "rolling",
    "spread", "spread_high", "threshold_ladder", "top_spreads", "widen",
]
