"""certflow: certificate and document analytics as Spark DataFrame jobs."""
