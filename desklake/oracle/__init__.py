"""DuckDB SQL that states each registered query independently."""

from desklake.oracle.reports import ORACLE_SQL

__all__ = ["ORACLE_SQL"]
