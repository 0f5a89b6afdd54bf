"""Where data comes from and goes to: captures, contracts, fetchers, tables."""
