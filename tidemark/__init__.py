"""Rating-event analytics on Spark: one event model, the same operators in batch and in streams."""
