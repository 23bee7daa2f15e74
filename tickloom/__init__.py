"""tickloom: OHLC time-series analytics as plain PySpark DataFrame functions."""
