"""Orrery: flat order lines to a star schema and its analyses, as Spark jobs."""
