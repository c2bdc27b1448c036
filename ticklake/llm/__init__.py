"""Training-data pipeline operators: scans, filters, deduplication and mixing.

Nothing else in the library imports this subpackage. ``catalog`` holds the
registered queries and their SQL.
"""
