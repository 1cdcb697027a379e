"""Operators: relational, statistics, text similarity, nearest neighbours."""
