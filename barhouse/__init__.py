"""A price-history lake on Spark: ingest, compact, reconcile, extract."""

from barhouse.datasets import DATASETS, KR_1D, KR_1M, US_5M, Dataset, dataset
from barhouse.plans.compact import compact_months, compact_years
from barhouse.plans.convert import convert_text, pending_days
from barhouse.plans.extract import extract, extract_day, extract_minute, extract_us, query, read_range
from barhouse.plans.loads import load_day_pages, load_minute_pages, load_ticker_csv
from barhouse.plans.writers import write_days, write_symbols, write_text, write_text_days
from barhouse.session import build_session, local_session

__all__ = [
    "DATASETS", "KR_1D", "KR_1M", "US_5M", "Dataset", "dataset",
    "compact_months", "compact_years", "convert_text", "pending_days",
    "extract", "extract_day", "extract_minute", "extract_us", "query", "read_range",
    "load_day_pages", "load_minute_pages", "load_ticker_csv",
    "write_days", "write_symbols", "write_text", "write_text_days",
    "build_session", "local_session",
]
