"""Behaviour-log job: clean (FIL-1, FIL-4), event time (STR-1), new-visitor
repair (STA-1, batch form) and the one-pass five-channel split (SPL-1..6).

Records stay ``map<string, variant>`` from the single parse to the final
``to_json``; every step is a JVM-side expression, so a whole stage runs
inside whole-stage codegen apart from the repair's shuffle on the device id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.functions.dates import DAY_MS, in_range, prev_day, ts_to_date, ts_to_day
from rillflow.functions.jsonvar import (
    as_object, drop_keys, get_long, get_str, is_object, keep_where, parse_object, present,
    put_keys, to_json_text,
)

LOG = "log"
CHANNELS = ("err", "start", "page", "display", "action")
DIRTY = "dirty"
OUT_OF_ORDERNESS = "3 seconds"
_OBJECT_KEYS = ("page", "start", "common", "err")


def _key(name: str) -> Column:
    return F.col(LOG)[name]


def parse_logs(raw: DataFrame, value: str = "value") -> DataFrame:
    """Parse each message once and derive the fields the jobs key on.

    Adds ``log`` (map<string,variant>), ``mid``, ``is_new``, ``ts`` and the
    boolean ``_dirty`` / ``_clean`` flags; keeps every input column.
    """
    df = raw.withColumn(LOG, parse_object(value))
    common = as_object(_key("common"))
    bad_type = F.lit(False)
    for k in _OBJECT_KEYS:
        bad_type = bad_type | (present(_key(k)) & ~is_object(_key(k)))
    ts = get_long(_key("ts"))
    bad_type = bad_type | (present(_key("ts")) & ~F.coalesce(in_range(ts), F.lit(False)))
    dirty = F.col(LOG).isNull() | bad_type
    mid = get_str(_key("common"), "$.mid")
    df = df.select(
        *raw.columns, F.col(LOG),
        mid.alias("mid"),
        get_str(_key("common"), "$.is_new").alias("is_new"),
        ts.alias("ts"),
        dirty.alias("_dirty"))
    clean = (~F.col("_dirty")
             & (is_object(_key("page")) | is_object(_key("start")))
             & common.isNotNull() & F.col("mid").isNotNull() & F.col("ts").isNotNull())
    return df.withColumn("_clean", F.coalesce(clean, F.lit(False)))


def clean_logs(raw: DataFrame, value: str = "value", keep_text: bool = False,
               keep_log: bool = True) -> DataFrame:
    """FIL-1: keep parseable logs with page or start, common, common.mid and ts.
    Without the text and the parsed record (``keep_log=False``) the rows are slim."""
    parsed = parse_logs(raw, value).drop("_dirty")
    gone = ([] if keep_text else [value]) + ([] if keep_log else [LOG])
    return keep_where(parsed.drop(*gone), "_clean")


def dirty_logs(raw: DataFrame, value: str = "value") -> DataFrame:
    """FIL-4: the quarantine: messages that do not parse as an object, hold a
    key of the wrong type (page, start, common or err not an object, ts not a
    number) or a ts that is no date in milliseconds. Valid logs that only lack a key are dropped silently
    by FIL-1 and do not appear here."""
    return keep_where(parse_logs(raw, value).select(*raw.columns, "_dirty"), "_dirty")


def tagged_logs(raw: DataFrame, value: str = "value") -> DataFrame:
    """FIL-1 and FIL-4 in one pass: clean records, and rejected messages marked ``_dirty``,
    which have their text in ``value`` and neither record nor device. ``dropped``: the
    display and action elements that the split leaves out (D19)."""
    parsed = parse_logs(raw, value)
    dirty = F.col("_dirty")
    tagged = parsed.select(
        *[c for c in raw.columns if c != value], F.when(dirty, F.col(value)).alias(value),
        *[F.when(~dirty, F.col(c)).alias(c) for c in (LOG, "mid", "is_new", "ts")], "_dirty",
        _dropped().alias("dropped"), (dirty | F.col("_clean")).alias("_keep"))
    return keep_where(tagged, "_keep")


def with_event_time(logs: DataFrame, delay: str = OUT_OF_ORDERNESS) -> DataFrame:
    """STR-1: event time from ``ts`` with a bounded out-of-orderness watermark.
    Nothing downstream drops late rows (the repair reads ``ts`` itself)."""
    return logs.withColumn("event_time", F.timestamp_millis("ts")) \
        .withWatermark("event_time", delay)


def visitor_candidate(zone: str | None = None) -> Column:
    """The date a record would write into the empty per-device state."""
    is_new = F.col("is_new")
    return (F.when(is_new == "1", ts_to_date("ts", zone))
            .when(is_new == "0", prev_day("ts", zone)))


def first_visit_days(logs: DataFrame, zone: str | None = None,
                     order: tuple[str, str] = ("ts", "seq")) -> DataFrame:
    """Per device, the state the sequential rule ends with: the candidate day of
    the first record (by ``order``, two longs) that has one. Day and order are numbers of
    fixed width, so the partial aggregation that absorbs hot devices before the shuffle
    is a hash aggregation: no log is sorted."""
    is_new = F.col("is_new")
    day = (F.when(is_new == "1", ts_to_day("ts", zone))
           .when(is_new == "0", ts_to_day(F.col("ts") - F.lit(DAY_MS), zone)))
    at = (F.col(order[0]).cast("decimal(19,0)") * F.lit(str(1 << 64)).cast("decimal(20,0)")
          + F.col(order[1]).cast("decimal(19,0)")).cast("decimal(38,0)")
    return (logs.select("mid", day.alias("day"), at.alias("at")).where("day is not null")
            .groupBy("mid").agg(F.min_by("day", "at").alias("first_day")))


def set_fixed_flag(logs: DataFrame) -> DataFrame:
    """Write ``fixed_is_new`` into ``common.is_new`` of records where it changed."""
    common = as_object(_key("common"))
    new_common = F.to_variant_object(
        put_keys(common, {"is_new": F.col("fixed_is_new").cast("variant")}))
    log = F.when(F.col("fixed_is_new") != F.col("is_new"),
                 put_keys(F.col(LOG), {"common": new_common})).otherwise(F.col(LOG))
    return logs.withColumn(LOG, log)


def apply_visitor_fix(logs: DataFrame, state: DataFrame, zone: str | None = None) -> DataFrame:
    """Join the per-device day back and rewrite ``common.is_new``.

    A "1" becomes "0" when the device's first day differs from the record's
    day; every record is kept. ``state`` has ``mid, first_day``.
    """
    joined = logs.join(state, "mid", "left")
    fixed = F.when((F.col("is_new") == "1") & (F.col("first_day") != ts_to_day("ts", zone)),
                   F.lit("0")).otherwise(F.col("is_new"))
    return set_fixed_flag(joined.withColumn("fixed_is_new", fixed).drop("first_day"))


def repair_new_visitors(logs: DataFrame, zone: str | None = None,
                        order: tuple[str, str] = ("ts", "seq"),
                        slim: DataFrame | None = None) -> DataFrame:
    """STA-1 (batch): equals the per-device sequential state machine.

    State S per device, written at most once: flag "1" with S set and S != date
    -> "0"; flag "1" with S empty -> S := date; flag "0" with S empty -> S :=
    date(ts - 24 h). The final S is the first candidate in order, and a "1"
    record changes exactly when S differs from its date. ``slim``: the same records
    without the parsed log, from which the state is computed.
    """
    return apply_visitor_fix(logs, first_visit_days(logs if slim is None else slim, zone, order),
                             zone)


# ----------------------------------------------------------------------- split
_ROW = "array<struct<channel:string,value:string>>"


def _rows(cond: Column, channel: str, values: Column | None = None,
          value: Column | None = None) -> Column:
    if value is not None:
        arr = F.array(F.struct(F.lit(channel).alias("channel"), value.alias("value")))
    else:
        arr = F.transform(values, lambda v: F.struct(F.lit(channel).alias("channel"),
                                                     v.alias("value")))
    return F.coalesce(F.when(cond, arr), F.array().cast(_ROW))


def _elements(key: str) -> Column:
    """Object elements of an array-valued key; anything else gives no element
    (the reference fails the job on these, see D19)."""
    items = _key(key).try_cast("array<variant>")
    return F.filter(F.transform(items, as_object), lambda e: e.isNotNull())


def _dropped() -> Column:
    def n_bad(key):
        items = _key(key).try_cast("array<variant>")
        return F.coalesce(F.size(items) - F.size(_elements(key)), F.lit(0))
    return n_bad("displays") + n_bad("actions")


def dropped_elements(logs: DataFrame) -> DataFrame:
    """Per record, display/action elements dropped for not being objects."""
    return logs.select("seq", _dropped().alias("dropped"))


def split_log(logs: DataFrame, channels: Sequence[str] = CHANNELS,
              numbered: bool = False) -> DataFrame:
    """SPL-1..6: every record to ``(seq, channel, value)`` rows in one pass, with ``n`` if
    ``numbered``.

    err: the err object alone. start: the record without err (start wins over
    page). page records: one display/action row per element with common, ts and
    page set on it, and the record itself without err, displays and actions. dirty (if
    asked for, of ``tagged_logs``): the text of a rejected message.

    ``n`` counts the rows of a record from 0: (seq, n) identifies a row.
    """
    log = F.col(LOG)
    err = as_object(_key("err"))
    is_start = is_object(_key("start"))
    is_page = ~is_start & is_object(_key("page"))
    stamp = {"common": _key("common"), "ts": F.col("ts").cast("variant"), "page": _key("page")}
    parts = {
        "err": lambda: _rows(err.isNotNull(), "err", value=to_json_text(err)),
        "start": lambda: _rows(is_start, "start", value=to_json_text(drop_keys(log, ["err"]))),
        "display": lambda: _rows(is_page, "display", F.transform(
            _elements("displays"), lambda e: to_json_text(put_keys(e, stamp)))),
        "action": lambda: _rows(is_page, "action", F.transform(
            _elements("actions"), lambda e: to_json_text(put_keys(e, stamp)))),
        "page": lambda: _rows(is_page, "page", value=to_json_text(
            drop_keys(log, ["err", "displays", "actions"]))),
        DIRTY: lambda: _rows(F.col("_dirty"), DIRTY, value=F.col("value")),
    }
    arrays = [parts[c]() for c in (*CHANNELS, DIRTY) if c in channels]
    rows = arrays[0] if len(arrays) == 1 else F.concat(*arrays)
    if not numbered:
        return logs.select("seq", F.inline(rows))
    return logs.select("seq", F.posexplode(rows).alias("n", "r")) \
        .select("seq", "n", "r.channel", "r.value")


def log_outputs(raw: DataFrame, zone: str | None = None) -> DataFrame:
    """All six outputs of the log job, ``(seq, n, channel, value)``: rejected messages take the
    same pass as the five channels, and no device state."""
    slim = clean_logs(raw, keep_log=False)
    return split_log(repair_new_visitors(tagged_logs(raw), zone, slim=slim), (*CHANNELS, DIRTY),
                     numbered=True)


def log_channels(raw: DataFrame, zone: str | None = None,
                 channels: Sequence[str] = CHANNELS) -> DataFrame:
    """The whole log job on a batch: clean -> repair -> split. The err channel
    carries no ``common``, so asking for it alone skips the repair's shuffle."""
    clean = clean_logs(raw)
    if set(channels) <= {"err"}:
        return split_log(clean, channels)
    return split_log(repair_new_visitors(clean, zone, slim=clean_logs(raw, keep_log=False)),
                     channels)
