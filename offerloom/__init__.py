"""offerloom: marketplace price intelligence as Spark DataFrame transformations."""
