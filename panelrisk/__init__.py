"""Risk analytics on yearly indicator panels, written as Spark DataFrame plans."""
