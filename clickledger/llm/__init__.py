"""Training-data operators: one module each, plus `registry` with the queries and their SQL."""
