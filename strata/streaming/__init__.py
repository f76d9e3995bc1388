from strata.streaming.incremental import read_fact, start_fact_stream, update_fact
from strata.streaming.landing import land_available, start_landing

__all__ = ["land_available", "read_fact", "start_fact_stream", "start_landing", "update_fact"]
