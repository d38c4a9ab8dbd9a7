"""Whole flows over an event table, and the queries bound to the test tables."""
