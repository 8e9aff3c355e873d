"""Plans: the end-to-end pipeline and the driver-table query registry."""
