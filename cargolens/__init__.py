"""Supply-chain analytics as lazy PySpark plans: clean, model, publish, report."""
