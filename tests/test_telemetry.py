"""Grid telemetry: the two reference cases plus boundary readings."""
import datetime as dt

from strata.streaming import telemetry as T

TS = dt.datetime(2024, 1, 1, 12, 0, 0)


def evaluate(spark, readings, nodes=None):
    df = spark.createDataFrame([(n, TS, v, l, f) for n, v, l, f in readings], T.READING_SCHEMA)
    ev = T.evaluate_readings(df, T.node_dim(spark, nodes or T.CONFIG_NODES))
    return {r.node_id + f"/{i}": r for i, r in enumerate(T.severity(ev).orderBy("voltage_kv", "load_pct", "frequency_hz").collect())}


def test_reference_frequency_case(spark):
    nodes = [{"id": "north", "endpoint": "10.0.0.1", "nominal_voltage_kv": 132.0, "nominal_frequency_hz": 50.0}]
    df = spark.createDataFrame([("north", TS, 132.0, 45.0, 51.2)], T.READING_SCHEMA)
    a = T.alerts(T.evaluate_readings(df, T.node_dim(spark, nodes))).collect()
    assert len(a) == 1
    assert len(a[0].issues) == 1 and "Frequency deviation" in a[0].issues[0]
    assert a[0].issues[0] == "Frequency deviation 1.200 Hz exceeds 0.500 Hz threshold"
    assert a[0].severity == "MEDIUM"


def test_node_id_alias(spark):
    n = T.node_dim(spark, [{"id": "legacy", "endpoint": "10.0.0.2", "nominal_voltage_kv": 11.0,
                            "nominal_frequency_hz": 50.0}]).collect()[0]
    assert (n.node_id, n.endpoint, n.nominal_voltage_kv, n.nominal_frequency_hz, n.region) == \
        ("legacy", "10.0.0.2", 11.0, 50.0, "default")


def test_boundaries(spark):
    north = "node-substation-north"   # 132 kV
    cases = [
        (north, 132.0 * 1.05, 10.0, 50.0),      # exactly 5 % -> no issue (strict)
        (north, 132.0, 90.0, 50.0),             # load exactly 90 -> none
        (north, 132.0, 90.1, 50.0),             # HIGH (load >= 90)
        (north, 132.0, 97.9, 50.0),             # HIGH
        (north, 132.0, 98.0, 50.0),             # CRITICAL
        (north, 132.0, 10.0, 50.5),             # exactly 0.5 Hz -> none
        (north, 200.0, 95.0, 52.0),             # three issues -> CRITICAL
        ("unknown-node", 11.0, 10.0, 50.0),     # defaults 11 kV / 50 Hz -> nominal
        (north, float("nan"), 10.0, 50.0),      # NaN -> quarantined, never an alert
        (north, None, 10.0, 50.0),              # null -> quarantined
    ]
    df = spark.createDataFrame([(n, TS, v, l, f) for n, v, l, f in cases], T.READING_SCHEMA)
    good, bad = T.split_bad(df)
    assert bad.count() == 2
    ev = T.severity(T.evaluate(T.with_nominals(good, T.node_dim(spark))))
    got = {(r.voltage_kv, r.load_pct, r.frequency_hz): (r.status, len(r.issues), r.severity) for r in ev.collect()}
    assert got[(132.0 * 1.05, 10.0, 50.0)][:2] == ("NOMINAL", 0)
    assert got[(132.0, 90.0, 50.0)][:2] == ("NOMINAL", 0)
    assert got[(132.0, 90.1, 50.0)] == ("WARNING", 1, "HIGH")
    assert got[(132.0, 97.9, 50.0)] == ("WARNING", 1, "HIGH")
    assert got[(132.0, 98.0, 50.0)] == ("WARNING", 1, "CRITICAL")
    assert got[(132.0, 10.0, 50.5)][:2] == ("NOMINAL", 0)
    assert got[(200.0, 95.0, 52.0)] == ("WARNING", 3, "CRITICAL")
    assert got[(11.0, 10.0, 50.0)][:2] == ("NOMINAL", 0)


def test_nominal_below_one_kv_uses_floor_of_one(spark):
    nodes = [{"id": "tiny", "endpoint": "e", "nominal_voltage_kv": 0.4}]
    df = spark.createDataFrame([("tiny", TS, 0.45, 10.0, 50.0)], T.READING_SCHEMA)
    ev = T.evaluate_readings(df, T.node_dim(spark, nodes)).collect()[0]
    # deviation 0.05 kV / max(0.4, 1) = 5 % -> not above the limit
    assert ev.status == "NOMINAL"


def test_alert_text(spark):
    df = spark.createDataFrame([("n", TS, 132.0, 95.0, 50.0)], T.READING_SCHEMA)
    a = T.alert_text(T.alerts(T.evaluate_readings(df, T.node_dim(spark)))).collect()[0]
    lines = a.message.split("\n")
    assert lines[0] == "Grid Alert — Severity: HIGH"
    assert lines[4] == "Load     : 95.0%"
    assert lines[-1] == "  • Load 95.0% exceeds capacity threshold 90.0%"


def test_outages_cross_bucket_and_active(spark):
    north = "node-substation-north"
    pts = [  # (minute offset, load) -- load > 90 means WARNING
        (0, 10.0), (50, 95.0), (59, 96.0), (61, 97.0), (70, 10.0),   # outage crossing the hour edge
        (130, 95.0), (200, 10.0),                                     # second outage
        (300, 99.0),                                                  # still active at the end
    ]
    base = dt.datetime(2024, 1, 1, 0, 0, 0)
    df = spark.createDataFrame([(north, base + dt.timedelta(minutes=m), 132.0, l, 50.0) for m, l in pts],
                               T.READING_SCHEMA)
    ev = T.evaluate_readings(df, T.node_dim(spark))
    got = sorted((r.event_id, r.start_time, r.end_time, r.is_active, tuple(r.affected_areas))
                 for r in T.outages(ev, T.node_dim(spark)).collect())
    m = lambda x: base + dt.timedelta(minutes=x)
    assert got == [
        (f"{north}-1", m(50), m(70), False, ("north",)),
        (f"{north}-2", m(130), m(200), False, ("north",)),
        (f"{north}-3", m(300), None, True, ("north",)),
    ]
