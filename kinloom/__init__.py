"""kinloom: large-scale record linkage expressed as Spark DataFrame transformations."""
