"""Reading raw feeds and layer tables."""
