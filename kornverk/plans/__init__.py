"""Queries over the tables, and the loop that fills a coverage plan."""
