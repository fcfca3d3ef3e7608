"""Listings, document bytes and result ledgers as DataFrames."""
