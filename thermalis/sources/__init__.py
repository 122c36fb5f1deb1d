from thermalis.sources.durable import scratch_path, scratch_run, settle
from thermalis.sources.models import load_model, save_model
from thermalis.sources.observations import clean_export, read_obs, read_raw, write_by_city, write_obs
from thermalis.sources.pixels import read_pixels, write_pixels
from thermalis.sources.results import (
    Publication, load_results, publish_tables, published, read_result, read_trend, remove_old_versions, write_result,
)
from thermalis.sources.views import register_views

__all__ = [
    "Publication", "clean_export", "load_model", "load_results", "publish_tables", "published", "read_obs", "read_pixels",
    "read_raw", "read_result", "read_trend", "register_views", "remove_old_versions", "save_model", "scratch_path",
    "scratch_run", "settle", "write_by_city", "write_obs", "write_pixels", "write_result",
]
