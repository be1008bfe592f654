"""Property checks: validation agrees with a plain-Python reading of the
envelope rule on randomly built messages; routing conserves messages."""

import json
import random
from datetime import datetime

from batchtrace import config as C
from batchtrace import schemas
from batchtrace.operators.dlq import classify_dlq
from batchtrace.operators.ingest import decode_raw, route

TS = datetime(2024, 1, 5)


def _random_member(rnd, keys):
    r = rnd.random()
    if r < 0.08:
        return rnd.choice(["text", 3, None, [1, 2], True])  # not an object
    obj = {}
    for k in keys + ["extra"]:
        x = rnd.random()
        if x < 0.15:
            continue  # missing
        obj[k] = None if x < 0.3 else (rnd.choice(["a", "b"]) if x < 0.9 else {"nested": 1})
    return obj


def _random_message(rnd):
    r = rnd.random()
    if r < 0.05:
        return rnd.choice(['"CORRUPT_TEXT"', "{bad", "", "[1]", "42", None])
    env = {}
    if rnd.random() > 0.1:
        env["metadata"] = _random_member(rnd, ["event_id", "event_type", "source"])
    if rnd.random() > 0.1:
        env["payload"] = _random_member(rnd, ["batch_id", "action", "event_timestamp"])
    return json.dumps(env)


def _expected_valid(text):
    try:
        env = json.loads(text)
    except (TypeError, ValueError):
        return False
    if not isinstance(env, dict):
        return False
    meta, payload = env.get("metadata"), env.get("payload")
    if not isinstance(meta, dict) or not isinstance(payload, dict) or "metadata" not in env or "payload" not in env:
        return False
    return {"event_id", "event_type"} <= meta.keys() and {"batch_id", "action"} <= payload.keys()


def test_validation_matches_python_rule(spark):
    rnd = random.Random(20241)
    texts = [_random_message(rnd) for _ in range(600)]
    topics = [rnd.choice([C.KITCHEN_TOPIC, C.DISPATCH_TOPIC, "elsewhere"]) for _ in texts]
    raw = spark.createDataFrame([(str(i), t, tp, TS) for i, (t, tp) in enumerate(zip(texts, topics))],
                                schemas.RAW_MESSAGE)
    got = {r["key"]: (r["is_valid"], r["route"]) for r in route(raw, keep_dropped=True).collect()}
    for i, (t, tp) in enumerate(zip(texts, topics)):
        valid = _expected_valid(t)
        exp_route = (None if tp == "elsewhere" else
                     C.ROUTE_DLQ if not valid else
                     C.ROUTE_CLEAN_KITCHEN if tp == C.KITCHEN_TOPIC else C.ROUTE_CLEAN_DISPATCH)
        assert got[str(i)] == (valid, exp_route), t
    # conservation: routed + dropped = input
    assert route(raw).count() + sum(tp == "elsewhere" for tp in topics) == len(texts)
    # every dead letter gets a reason; only structurally-valid-but-null cases reach "Others"
    dead = classify_dlq(decode_raw(route(raw).filter("route = 'dlq'")))
    assert dead.filter("error_reason is null").count() == 0
