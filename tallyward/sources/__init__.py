"""Table contracts, table storage and the claim views over the test tables."""
