"""Readers, declared schemas, cleaned tables and writers."""
