"""Exports that follow refreshes as a file stream."""
