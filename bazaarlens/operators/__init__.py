"""Frame-level operators: keep-one-row, global ordering, shares, bands, 1-D k-means."""
