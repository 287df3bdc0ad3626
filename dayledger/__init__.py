"""dayledger: change-data-driven daily KPI analytics as PySpark DataFrame jobs."""
