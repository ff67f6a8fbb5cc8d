"""Spark-native competition analytics: nested JSON → silver → gold → warehouse, quality, dashboards, monitoring."""
