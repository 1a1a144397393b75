"""Tables in: readers, contracts, the test-data adapter; tables out: publishing and the lookup store."""
