"""Reading raw files and keeping the layered tables."""
