"""Business rules as data: thresholds, labels and points."""
