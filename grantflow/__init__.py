"""grantflow: keep a keyed table of funding opportunities current, on Spark."""
