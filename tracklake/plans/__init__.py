"""Composed plans: catalog requests, KPI marts, batch jobs, named test plans."""
