"""A multi-tenant help-desk ticket lake expressed as Spark DataFrame jobs."""
