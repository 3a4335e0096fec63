from pulseboard.functions.numeric import (  # noqa: F401
    calc_rate, exact_avg, key_or_unknown, r2, rate, stage_is,
)
from pulseboard.functions.time import (  # noqa: F401
    bucket_start, interval_micros, parse_interval,
)
