"""Retail analytics on Spark: landing, stock, profitability, reconciliation, approval queue, access, quality."""
