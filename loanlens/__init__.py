"""Lending-portfolio analytics as Spark jobs."""
