"""Part of the hearken engine: streaming."""
