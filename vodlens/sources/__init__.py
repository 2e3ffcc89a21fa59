"""Readers: raw logs, dimensions, view logs, titles, promotion feeds."""
