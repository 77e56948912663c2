"""Lakehouse layers on plain Spark: bronze loads, conformed silver, change history and marts."""
