"""Writers: aggregate results, day summaries, daily log layout."""

from .csv import csv_line, next_result_name, write_daily, write_result, write_summaries

__all__ = ["next_result_name", "write_daily", "write_result", "write_summaries"]
