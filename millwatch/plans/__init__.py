"""Stages put together: the medallion job and the registered queries."""
