"""Tidewell: retail recommendation, offer and corpus operators on Spark."""
