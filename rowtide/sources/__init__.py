"""Reading snapshots and writing targets."""
