"""Readers and writers: archives, CSV folders, typed tables, test-table mappings."""
