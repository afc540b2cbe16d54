"""The continuous form of the measurement load."""
