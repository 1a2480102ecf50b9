"""Trip-table and price-series analytics as PySpark DataFrame operators."""
