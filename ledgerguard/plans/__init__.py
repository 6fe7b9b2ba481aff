"""Batch report plans over the lakes and the registered query catalogue."""
