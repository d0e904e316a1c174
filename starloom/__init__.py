"""starloom: star-catalogue analytics as ordinary Spark DataFrame transformations."""
