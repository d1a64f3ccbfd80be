"""Readers and writers: landed JSON, versioned tables, message topics."""
