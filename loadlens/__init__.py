"""loadlens: Spark-native usage analytics for appliance power readings.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark's
own aggregations, joins and windows.  Time is carried as epoch seconds
(``t``, long) and the business calendar is JST (UTC+9, no DST).
"""

__all__ = ["settings", "session"]
