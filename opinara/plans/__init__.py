"""Stages: cleaning, sentiment, topics, warehouse, reports, KPIs and dashboard filters."""
