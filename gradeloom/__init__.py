"""Exam results and school registry tables on Spark."""
