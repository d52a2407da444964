"""Queries over the test tables, and independent SQL that must agree with them."""
