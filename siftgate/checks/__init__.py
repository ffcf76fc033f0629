"""Queries over the given tables, one per operator, each with the same answer in SQL where SQL can say it."""
