"""Appends to tables, files and topics."""
