"""Queries over a shop dataset that exercise every operator, and the SQL that checks them."""
