"""Civic open-data tables on Spark: clean, load by month, place on a map, report."""

from wardgrid.session import apply_settings, build_session, shared_folder

__all__ = ["apply_settings", "build_session", "shared_folder"]
