"""Operators for preparing training text: filters, near duplicates, packing, scans and extraction."""
