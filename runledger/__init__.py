"""Audit logs of agentic runs, kept and queried with Spark."""
