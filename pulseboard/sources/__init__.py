from pulseboard.sources.events import (  # noqa: F401
    fixture_events, flatten_events, read_table, read_tracking_events,
)
