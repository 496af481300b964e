"""Quality control, grading and publishing of water-quality grab samples on Spark."""

__version__ = "0.1.0"
