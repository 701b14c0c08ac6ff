"""Landed payloads, tables and files in and out."""
