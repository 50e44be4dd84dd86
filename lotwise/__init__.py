"""lotwise: vehicle-acquisition analytics as Spark DataFrame operators."""
