"""Readers: star-schema views, snapshots, the file lake and relational tables."""
