"""Operators for preparing training data: dedup, quality, archives, licences, search,
mixing and packing. Nothing else in the library imports this package."""
