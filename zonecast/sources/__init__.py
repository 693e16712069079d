"""File scans, documents and keyed tables."""
