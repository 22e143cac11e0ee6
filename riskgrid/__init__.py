"""riskgrid: rare-event risk analytics on gridded observations, on Spark."""

__version__ = "0.1.0"
