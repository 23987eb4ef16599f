"""Part of the lorespark engine."""
