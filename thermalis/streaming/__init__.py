from thermalis.streaming.alerts import hotspot_stream, stream_obs, write_alerts

__all__ = ["hotspot_stream", "stream_obs", "write_alerts"]
