"""The registered series. Their order is the column order of the wide form."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Series:
    series_id: str
    provider: str
    native_shape: str
    fetch: str
    unit: str


# Identifiers, providers and units of the registered series.
REGISTRY: tuple[Series, ...] = (
    Series("vix", "CBOE", "ohlc", "full_file", "index_points"),
    Series("vix9d", "CBOE", "ohlc", "full_file", "index_points"),
    Series("vix3m", "CBOE", "ohlc", "full_file", "index_points"),
    Series("vix6m", "CBOE", "ohlc", "full_file", "index_points"),
    Series("vix1y", "CBOE", "ohlc", "full_file", "index_points"),
    Series("vstoxx", "STOXX", "scalar", "full_file", "index_points"),
    Series("vstoxx1m", "STOXX", "scalar", "full_file", "index_points"),
    Series("vstoxx2m", "STOXX", "scalar", "full_file", "index_points"),
    Series("vstoxx3m", "STOXX", "scalar", "full_file", "index_points"),
    Series("move", "Yahoo", "ohlc", "date_range", "index_points"),
    Series("ciss", "ECB", "scalar", "date_range", "index"),
    Series("ciss_money", "ECB", "scalar", "date_range", "dimensionless_contribution"),
    Series("ciss_bonds", "ECB", "scalar", "date_range", "dimensionless_contribution"),
    Series("ciss_equity", "ECB", "scalar", "date_range", "dimensionless_contribution"),
    Series("ciss_financials", "ECB", "scalar", "date_range", "dimensionless_contribution"),
    Series("estr", "ECB", "scalar", "date_range", "percent"),
    Series("euro_hy_oas", "FRED", "scalar", "date_range", "percent"),
    Series("euro_hy_yield", "FRED", "scalar", "date_range", "percent"),
    Series("euro_hy_ytw", "FRED", "scalar", "date_range", "percent"),
    Series("euro_hy_total_return", "FRED", "scalar", "date_range", "index"),
    Series("us_2y", "FRED", "scalar", "date_range", "percent"),
    Series("us_10y", "FRED", "scalar", "date_range", "percent"),
    Series("usd_broad", "FRED", "scalar", "date_range", "index"),
    Series("us_3m", "FRED", "scalar", "date_range", "percent"),
    Series("us_5y", "FRED", "scalar", "date_range", "percent"),
)
IDS: tuple[str, ...] = tuple(s.series_id for s in REGISTRY)
OHLC: tuple[str, ...] = tuple(s.series_id for s in REGISTRY if s.native_shape == "ohlc")
if len(set(IDS)) != len(IDS):
    raise ValueError("a series is registered twice")
