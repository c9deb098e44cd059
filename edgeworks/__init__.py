"""Edge lists, scored links and row matrices on the Spark DataFrame API."""
