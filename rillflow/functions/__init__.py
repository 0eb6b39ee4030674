from rillflow.functions.jsonvar import (  # noqa: F401
    as_object, drop_keys, get_long, get_str, is_object, keep_keys, parse_object,
    present, put_keys, to_json_text,
)
from rillflow.functions.dates import (  # noqa: F401
    date_to_ts, datetime_to_ts, prev_day, ts_to_date, ts_to_date_partition,
    ts_to_datetime, ntz_to_millis,
)
