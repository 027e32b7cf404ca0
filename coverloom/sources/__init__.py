"""Readers for the five raw tables and the store the marts are written to."""

from coverloom.sources.raw import GivenTables, RawTables, read_raw

__all__ = ["GivenTables", "RawTables", "read_raw"]
