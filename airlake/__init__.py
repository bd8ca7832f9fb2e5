"""airlake: environmental sensor time series as composable PySpark DataFrame operators."""

from airlake.config import CONFIG, Config
from airlake.session import build_session, shared_path, use_utc

__all__ = ["CONFIG", "Config", "build_session", "shared_path", "use_utc"]
