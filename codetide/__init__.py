"""codetide: code property graphs and their change streams as Spark jobs."""

__version__ = "1.0.0"
