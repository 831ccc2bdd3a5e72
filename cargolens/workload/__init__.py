"""The registered queries: package plans over the benchmark tables, and their SQL."""
