"""tessera: a Spark-native engine for geospatial feature layers and trajectories."""

__version__ = "0.1.0"
