"""Part of the hearken engine: functions."""
