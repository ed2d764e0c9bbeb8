"""churnlab - subscription analytics (funnels, engagement cohorts, subscription
economics, experiments, data-quality checks) as Spark DataFrame jobs."""

__version__ = "0.1.0"
