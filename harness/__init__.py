"""Checks of the library on the provided tables: trip view, registered queries, oracle SQL."""
