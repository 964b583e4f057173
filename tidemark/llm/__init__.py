"""Training-data operators: mixing, deduplication, scanning, classification, packing.

Nothing outside this subpackage imports it.
"""
