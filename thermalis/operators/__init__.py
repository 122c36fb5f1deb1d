from thermalis.operators import aggregates, features, forecast, hotspots, ingest, pixels, serving, temporal

__all__ = ["aggregates", "features", "forecast", "hotspots", "ingest", "pixels", "serving", "temporal"]
