"""Market-data analytics on PySpark: bars, order-flow factors, comparison, replay and streaming."""
