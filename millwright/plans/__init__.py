"""Multi-step plans: bronze to gold, cleaning, and the dashboards."""
