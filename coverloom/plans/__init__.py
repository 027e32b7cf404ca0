"""Marts, analyst queries and dashboard datasets."""
