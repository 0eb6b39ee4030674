"""The whole batch log job (clean -> repair -> split) equals a record-at-a-time
simulation of the reference's rules on random logs."""

import datetime as dt
import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rillflow.operators import logs

DAY = 86_400_000
T0 = 1_704_067_200_000


class Dirty(Exception):
    pass


def _obj(d, k):
    v = d.get(k)
    if v is None:
        return None
    if not isinstance(v, dict):
        raise Dirty
    return v


def _long(d, k):
    v = d.get(k)
    if v is None:
        return None
    if isinstance(v, bool):
        raise Dirty
    if isinstance(v, int):
        return v
    if isinstance(v, str) and v.lstrip("-").isdigit():
        return int(v)
    raise Dirty


def _date(ms):
    return dt.datetime.fromtimestamp(ms / 1000, dt.timezone.utc).strftime("%Y-%m-%d")


def _text(d):
    return json.dumps({k: v for k, v in d.items() if v is not None}, sort_keys=True)


def simulate(records):
    clean = []
    for seq, text in records:
        try:
            obj = json.loads(text)
            if not isinstance(obj, dict):
                raise Dirty
            page, start, common, ts = (_obj(obj, "page"), _obj(obj, "start"),
                                       _obj(obj, "common"), _long(obj, "ts"))
        except (ValueError, Dirty):
            continue
        if (page is not None or start is not None) and common is not None \
                and common.get("mid") is not None and ts is not None:
            clean.append((ts, seq, obj))
    state, out = {}, []
    for ts, seq, obj in sorted(clean, key=lambda r: (r[0], r[1])):
        common = obj["common"]
        flag, d, s = common.get("is_new"), _date(ts), state.get(common["mid"])
        if flag == "1":
            if s is not None and s != d:
                common["is_new"] = "0"
            elif s is None:
                state[common["mid"]] = d
        elif flag == "0" and s is None:
            state[common["mid"]] = _date(ts - DAY)
        err = obj.get("err")
        if isinstance(err, dict):
            out.append(("err", seq, _text(err)))
            obj.pop("err")
        if obj.get("start") is not None:
            out.append(("start", seq, _text(obj)))
        elif obj.get("page") is not None:
            for key, channel in (("displays", "display"), ("actions", "action")):
                items = obj.pop(key, None)
                for item in items or []:
                    item = {**item, "common": common, "ts": ts, "page": obj["page"]}
                    out.append((channel, seq, _text(item)))
            out.append(("page", seq, _text(obj)))
    return sorted(out)


element = st.dictionaries(st.sampled_from(["item", "pos", "ts", "page", "common"]),
                          st.one_of(st.integers(0, 9), st.sampled_from(["a", "b"])),
                          max_size=3)
record = st.fixed_dictionaries({}, optional={
    "common": st.one_of(st.none(), st.fixed_dictionaries(
        {"mid": st.sampled_from(["m1", "m2"])},
        optional={"is_new": st.sampled_from(["0", "1", "x"]), "ch": st.just("c")})),
    "page": st.one_of(st.none(), st.just({}), st.just({"page_id": "p1"})),
    "start": st.just({"entry": "e"}),
    "err": st.one_of(st.none(), st.just({"error_code": 3})),
    "displays": st.lists(element, max_size=3),
    "actions": st.lists(element, max_size=2),
    "ts": st.one_of(st.integers(0, 3 * DAY).map(lambda x: T0 + x),
                    st.integers(0, 3 * DAY).map(lambda x: str(T0 + x)), st.none()),
    "x": st.one_of(st.none(), st.integers(0, 5)),
})
message = st.one_of(record.map(json.dumps), st.sampled_from(["x", '{"a":1', "[1]", "null"]))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.too_slow,
                                                                  HealthCheck.function_scoped_fixture])
@given(st.lists(message, min_size=1, max_size=40))
def test_log_job_equals_simulation(spark, messages):
    records = list(enumerate(messages))
    raw = spark.createDataFrame(records, "seq long, value string")
    got = sorted((r["channel"], r["seq"], _text(json.loads(r["value"])))
                 for r in logs.log_channels(raw, "UTC").collect())
    assert got == simulate([(s, t) for s, t in records])
