"""Part of skeinwork."""
