"""End-to-end batch runs."""
