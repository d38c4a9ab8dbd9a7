from trendcast.sources.tables import (
    read_events, read_hyperparameters, write_events, write_table,
)

__all__ = [
    "read_events", "read_hyperparameters", "write_events", "write_table",
]
