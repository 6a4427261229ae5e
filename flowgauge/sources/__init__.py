"""Reading, writing, and the adapters from the test tables."""
