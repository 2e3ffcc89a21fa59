"""Sinks: JDBC tables, file tables and JSON results, XML payloads."""

from .files import write_json_result, write_table, xml_rows
from .jdbc import append_if_rows, append_jdbc

__all__ = ["append_if_rows", "append_jdbc", "write_json_result", "write_table", "xml_rows"]
