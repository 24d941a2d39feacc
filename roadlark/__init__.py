"""roadlark: incident-post analytics as PySpark DataFrame jobs."""

from roadlark.operators.fill import fill_event_time, forward_fill
from roadlark.operators.parse import parse_posts
from roadlark.operators.vehicles import classify_vehicles, explode_vehicles
from roadlark.plans.batch import enrich_locations, process_batch
from roadlark.plans.load import audit, load_warehouse
from roadlark.sources.pages import extract_posts
from roadlark.sources.tables import Warehouse
from roadlark.streaming.incremental import run_ingest, start_ingest

__all__ = [
    "Warehouse", "audit", "classify_vehicles", "enrich_locations", "explode_vehicles",
    "extract_posts", "fill_event_time", "forward_fill", "load_warehouse", "parse_posts",
    "process_batch", "run_ingest", "start_ingest",
]
