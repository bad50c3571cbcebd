"""Early-window event features and length-of-stay models on Spark."""

__version__ = "0.1.0"
