"""Readers and writers: tab exports, CSV, versioned tables, SQL tables and log folders."""
