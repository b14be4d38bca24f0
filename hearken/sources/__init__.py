"""Part of the hearken engine: sources."""
