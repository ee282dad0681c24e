"""Halyard: hourly environmental data and rule documents as plain Spark DataFrame operators."""
