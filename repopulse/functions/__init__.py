"""Column functions shared by the operators, all built from Spark's own."""

from repopulse.functions.columns import as_date, day_of, json_text, present, repeat_rows

__all__ = ["as_date", "day_of", "json_text", "present", "repeat_rows"]
