"""Driver queries: adapters from the test tables, Spark plans and their oracle SQL."""
