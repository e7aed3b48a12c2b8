"""Query plans over the driver tables: the stand-in mapping from TPC-H-like
tables to sales lines, the query catalog and the DuckDB oracle SQL."""
