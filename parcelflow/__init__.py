"""Order-fulfilment analytics as Spark DataFrame functions."""
