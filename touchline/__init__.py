"""Football analytics on Spark: player seasons in batch, shots as a stream."""
