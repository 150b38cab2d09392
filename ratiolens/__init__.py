"""Daily ratio-KPI anomaly detection and root-cause analysis on Spark."""
