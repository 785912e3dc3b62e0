"""Incremental upkeep of the order fulfilment snapshot."""
