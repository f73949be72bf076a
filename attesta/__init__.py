"""Rights-aware corpus analytics expressed as Spark DataFrame transformations."""
