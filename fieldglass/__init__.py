"""fieldglass: relational and training-data operators as Spark DataFrame plans."""
