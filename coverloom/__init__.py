"""Policy, payment and churn analytics as Spark DataFrame jobs."""
