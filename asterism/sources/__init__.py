"""Readers: landed JSON, tables, generated date series."""
