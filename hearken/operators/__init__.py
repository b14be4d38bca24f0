"""Part of the hearken engine: operators."""
