"""Queries over the driver's tables, one an operator, each with its SQL."""
