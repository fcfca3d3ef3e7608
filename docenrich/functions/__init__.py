"""Pure Column functions."""
