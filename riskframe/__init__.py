"""Risk and drift analytics for rare-event tables, as Spark DataFrame operators."""
