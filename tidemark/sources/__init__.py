"""Readers for text, literal rows and event tables, as tables or streams."""
