"""cartwright: customer order features and segmentation as plain Spark jobs."""

__version__ = "0.1.0"
