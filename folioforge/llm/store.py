"""Intermediate tables: see :mod:`folioforge.sources.stage`."""

from folioforge.sources.stage import shared_dir, table

__all__ = ["shared_dir", "table"]
