"""Part of the hearken engine: plans."""
