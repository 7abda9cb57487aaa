"""Readers and writers for streams, files, tables and run logs."""
