"""Yearbook: periodic entity metrics (annual company figures and the like) on Spark.

Every operator takes DataFrames and returns a DataFrame; nothing runs until the
caller acts on the result, except the pass/fail gates, which say so.
"""

from yearbook.errors import YearbookError

__all__ = ["YearbookError"]
