"""The declared officer and dispatch features."""

import datetime as dt

from retrospect.operators import banding, blocks, event_features
from retrospect.plans import dispatches, officers


def test_all_officer_features_are_declared():
    names = officers.feature_names()
    assert len(officers.BLOCKS) == 15 and len(names) == 93


def test_all_dispatch_features_are_declared():
    known = dispatches.catalogue()
    assert len(known) == 218
    assert all(hasattr(event_features, f) or hasattr(banding, f) for f, _ in known.values())


def test_a_block_is_built_from_its_tables(spark):
    stops = spark.createDataFrame([(1, 7, dt.datetime(2016, 1, 15), True, 2), (1, 8, dt.datetime(2016, 1, 20), False, 1)], "officer_id int, event_id int, event_datetime timestamp_ntz, flag boolean, race int")
    stops = stops.selectExpr("officer_id", "event_id", "event_datetime", *(f"flag as {c}" for c in ("searched_flag", "use_of_force_flag", "arrest_flag", "injuries_flag", "officer_injury_flag", "search_consent_request_flag")), *(f"race as {c}" for c in ("stopped_person_race_code", "stop_type_code", "stop_outcome_code", "search_justification_code")))
    lookup = spark.createDataFrame([(1, "One"), (2, "Two")], "code int, value string")
    lookups = dict.fromkeys(("lookup_races", "lookup_traffic_stop_type", "lookup_traffic_stop_outcome_type", "lookup_search_justifications"), lookup)
    block = officers.build("TrafficStops", stops, lookups, {"P1M": (1, 0)})
    row = blocks.lookback(stops, spark.createDataFrame([(dt.datetime(2016, 2, 1),)], "as_of_date timestamp_ntz"), block).first()
    assert row["ts_id_p1m_trafficstopswithsearch_sum"] == 1 and row["ts_id_p1m_trafficstops_count"] == 2
    assert row["ts_id_p1m_trafficstopsbyrace_two_sum"] == 1
