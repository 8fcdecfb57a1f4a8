"""pagemark: page annotation analytics as Spark DataFrame jobs."""
