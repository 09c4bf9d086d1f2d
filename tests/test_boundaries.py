"""Small cases whose rows follow by hand."""

import datetime as dt
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from retrospect.functions import anonymize
from retrospect.operators import banding, blocks, catalog, evaluate, event_features, labels, matrix, models, results, temporal
from retrospect.operators.blocks import Block, Quantity
from retrospect.plans import reports
from retrospect.sources import io


def at(text):
    return dt.datetime.fromisoformat(text)


def test_lookback_window_is_closed_below_and_open_above(spark):
    rows = [(1, at("2015-12-31 23:59:59"), 1), (1, at("2016-01-01"), 1), (1, at("2016-01-31 23:59:59"), 2), (1, at("2016-02-01"), 1), (2, at("2016-01-15"), None)]
    events = spark.createDataFrame(rows, "e int, t timestamp_ntz, code int")
    dates = spark.createDataFrame([(at("2016-02-01"),)], "as_of_date timestamp_ntz")
    block = Block("b", "e", "t", [*blocks.lookup_quantities("code", "code", [(1, "One")]), Quantity("rows", "1", ("count",))], {"P1M": (1, 0)})
    out = {r["e"]: r for r in blocks.lookback(events, dates, block).collect()}
    assert (out[1]["b_id_p1m_rows_count"], out[1]["b_id_p1m_code_one_sum"], out[1]["b_id_p1m_code_one_avg"]) == (2, 1, 0.5)
    assert (out[2]["b_id_p1m_code_one_sum"], out[2]["b_id_p1m_code_one_avg"]) == (None, None)


@pytest.mark.parametrize(("closed", "n"), [(True, 2), (False, 1)])
def test_band_ends(spark, closed, n):
    left = spark.createDataFrame([(1, at("2016-01-01 12:00:00"))], "id int, t timestamp_ntz")
    right = spark.createDataFrame([(at(f"2016-01-01 {x}"),) for x in ("10:59:59", "11:00:00", "12:00:00", "12:00:01")], "r timestamp_ntz")
    assert banding.band_counts(left, right, "id", "t", "r", {"n": 3600}, closed).first()["n"] == n


def test_as_of_dates_clamp_step_by_step(spark):
    got = [str(r[0]) for r in temporal.as_of_dates(spark, "2015-11-30", "2016-03-31", (1, 0)).orderBy("as_of_date").collect()]
    assert got == ["2015-12-29", "2016-01-29", "2016-02-29", "2016-03-31"]


def test_temporal_splits(spark):
    splits = temporal.temporal_splits(spark, "2014-01-01", "2016-01-01", [(12, 0)], [(6, 0)], [(12, 0)], [(6, 0)], [(0, 1)], [(0, 0)], [(12, 0)])
    rows = splits.orderBy(F.desc("test_end")).collect()
    assert [str(r["test_end"]) for r in rows] == ["2016-01-01", "2015-07-01", "2015-01-01", "2014-07-01"]
    assert [str(d) for d in rows[0]["train_dates"]] == ["2014-01-01", "2014-07-01", "2015-01-01"]


@pytest.mark.parametrize(("day", "closed", "inside"), [("2016-01-01", False, False), ("2016-01-15", False, True), ("2016-02-01", False, False), ("2016-02-01", True, True)])
def test_prediction_window(spark, day, closed, inside):
    events = spark.createDataFrame([(at(day), at(day))], "min_date timestamp_ntz, max_date timestamp_ntz")
    dates = spark.createDataFrame([(at("2016-01-01"),)], "as_of_date timestamp_ntz")
    assert (labels.forward_window(events, dates, (1, 0), closed).count() == 1) is inside


def test_conditions_hold_on_one_event(spark):
    pairs = spark.createDataFrame([(1, ["A", "C"]), (2, ["A"]), (3, ["B"])], "id int, pairs array<string>")
    hit = pairs.filter(labels.matches(F.col("pairs"), [[["A"]], [["B"], ["C"]]]))
    assert [r["id"] for r in hit.collect()] == [1]


def test_ranked_cut_offs(spark):
    rows = [(i, s, 1, y) for i, (s, y) in enumerate([(0.9, 1), (0.8, 0), (0.7, 1), (0.4, 0), (0.2, 0)])]
    scores = spark.createDataFrame(rows, "id int, score double, pred int, label int")
    got = {(r["metric"], r["parameter"]): r["value"] for r in evaluate.cut_metrics(scores, [], [1, 2, 3, 5]).collect()}
    four = lambda k: [got[f"{m} {s}@", f"{k}_abs"] for m, s in (("true", "positives"), ("false", "positives"), ("false", "negatives"), ("true", "negatives"))]
    assert [four(k) for k in (1, 2, 3, 5)] == [[1, 0, 1, 3], [1, 1, 1, 2], [2, 1, 0, 2], [2, 3, 0, 0]]
    curve = {r["metric"]: r["value"] for r in evaluate.curve_metrics(scores).collect()}
    assert curve["auc"] == pytest.approx(5 / 6) and curve["average precision score"] == pytest.approx(5 / 6)


def test_dense_ranks_and_movement(spark):
    p = spark.createDataFrame([(1, at("2016-01-01"), i, s) for i, s in enumerate([0.9, 0.9, 0.5])], "model_id int, as_of_date timestamp_ntz, entity_id int, score double")
    assert sorted(r["rank_abs"] for r in models.prediction_ranks(p).collect()) == [1, 1, 2]
    days = spark.createDataFrame([(7, at(f"2016-01-0{k}"), v) for k, v in ((1, 0.5), (2, 0.4), (3, 0.1))], "entity_id int, as_of_date timestamp_ntz, rank_pct double")
    rows = results.rank_movement(days, days).orderBy("as_of_date").collect()
    assert [None if r["last_day"] is None else round(r["last_day"], 3) for r in rows] == [None, -0.1, -0.3]
    assert all(r["last_week"] is None for r in rows)


def test_feature_name(spark):
    r = catalog.parse_names(spark.createDataFrame([("ir_id_P1Y_IncidentsOfType_use_of_force_sum",)], "column_name string")).first()
    assert (r["block"], r["window"], r["feature"], r["type"], r["metric"]) == ("ir", "P1Y", "IncidentsOfType", "use_of_force", "sum")


def test_movement_rate(spark):
    rows = spark.createDataFrame([(6, 3, 1), (0, 0, 0)], "a int, b int, c int")
    assert [r["m"] for r in blocks.movement_rate(rows, ["a", "b", "c"], "m").collect()] == [0.667, 0.0]


def test_name_forms(spark):
    names = spark.createDataFrame([(0, "ID1", "Ann", "Bea", "Cole"), (1, "ID2", "Ann", None, "Dole")], "n int, id string, first string, middle string, last string")
    forms = {r["pattern"]: r["id"] for r in anonymize.name_forms(names, "n").collect()}
    assert {k for k, v in forms.items() if v == "ID1"} == {"cole", "ab cole", "ann cole", "a cole", "ann b cole"}
    assert {k for k, v in forms.items() if v == "ID2"} == {"dole", "ann dole", "a dole"}
    assert sum(v == "ID2?" for v in forms.values()) == 26


def test_anonymize(spark):
    names = spark.createDataFrame([(0, "ID1", "Ann", "Bea", "Cole")], "n int, id string, first string, middle string, last string")
    texts = spark.createDataFrame([(1, "Officer Cole met #123-4 and Cole left."), (2, "the officers A Cole and Ann Cole."), (3, "cole is coal"), (4, None), (5, "")], "k int, text string")
    got = {r["k"]: r["text"] for r in anonymize.anonymize(texts, names, "k", "text", "n").collect()}
    assert got == {1: "officer ID1 met BADGENUM and ID1 left", 2: "the officers ID1 and ID1", 3: "cole is coal", 4: None, 5: ""}


def _brute_anonymize(text, forms):
    roles = [r.lower() for r in anonymize.ROLES]
    text = text.lower()
    for pattern in anonymize.BADGE_PATTERNS:
        text = re.sub(pattern, anonymize.BADGE, text)
    words = re.sub(r"[ \t\n\x0b\f\r]+", " ", text.translate({ord(c): None for c in anonymize.PUNCTUATION})).strip(" ").split(" ")
    found = {}
    for k in range(len(words)):
        for size in (1, 2, 3):
            if k + size <= len(words) and (run := " ".join(words[k : k + size])) in forms:
                found[k] = (size, run)
    named = {j for k, (size, _) in found.items() for j in range(k, k + size)}
    known, opened = set(), False
    for k, w in enumerate(words):
        plural = w in {r + "s" for r in roles}
        opened = plural or (opened and (k in named or w == "and" or w in roles))
        single = any(k >= n and words[k - n] in {r.split()[-1] for r in roles} for n in (1, 2))
        if k in found and (opened or single):
            known.add(found[k][1])
    out, reach = [], 0
    for k, w in enumerate(words):
        if k in found and found[k][1] in known and k >= reach:
            out.append(forms[found[k][1]])
            reach = k + found[k][0]
        elif k >= reach:
            out.append(w)
    return " ".join(out)


def test_people_are_all_words(spark, tmp_path):
    rng = np.random.default_rng(3)
    vocabulary = ["".join(rng.choice(list("abcdefgh"), 7)) for _ in range(400)]
    texts = [" ".join(rng.choice([*vocabulary, "and", "of", "the", "#123-4", "Sgt"], 60)) for _ in range(12)]
    rows = [*enumerate(texts), (50, None), (51, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    used = {w for t in texts for w in t.split() if w in vocabulary}
    assert len(used) > 60
    people = reports._names(spark, str(tmp_path)).collect()
    assert len({r["person"] for r in people}) == len({r["id"] for r in people}) == len(people) >= len(used) / 3
    forms = {r["pattern"]: r["id"] for r in reports.name_forms(spark, str(tmp_path)).collect()}
    assert {r["last"] for r in people} <= set(forms) and all(r["last"] in used for r in people)
    got = {r["doc_id"]: r["text"] for r in reports.anonymized(spark, str(tmp_path)).collect()}
    for k, text in enumerate(texts):
        words = text.split(" ")
        roles = {0: "officer ", 9: "sergeants "}
        assert got[k] == _brute_anonymize(" ".join(roles.get(i % 18, "") + w for i, w in enumerate(words)), forms)
    assert sum(w.startswith("ID") for k in range(len(texts)) for w in got[k].split()) > 3 * len(texts)
    assert any("sergeants ID" in got[k] for k in range(len(texts)))
    assert got[50] is None and got[51] == "officer"


def test_names_after_roles_at_random():
    """Forms of one to three words, roles and lists of names in any order; a filter that passes every run or some changes nothing."""
    rng, roles = np.random.default_rng(8), anonymize.Roles.of(anonymize.ROLES)
    replaced = 0
    for turn in range(400):
        vocabulary = list("abcde") + ["officer", "officers", "sgts", "chief", "and", "of", "chiefs x"][: 2 + turn % 6]
        forms = {" ".join(rng.choice(vocabulary, 1 + rng.integers(3))): f"ID{k}" for k in range(turn % 9)}
        text = " ".join(rng.choice(vocabulary, rng.integers(1, 40)))
        words = text.split(" ")
        for maybe in (forms.__contains__, lambda run: True, lambda run: run in forms or len(run) % 2 == 0):
            asked = anonymize.asked_forms(words, roles, maybe)
            got = " ".join(anonymize.with_ids(words, roles, {r: forms[r] for r in asked if r in forms}))
            assert got == _brute_anonymize(text, forms)
        replaced += got != text
    assert replaced > 100


def test_anonymize_repeated_rows_and_null_keys(spark):
    names = spark.createDataFrame([(0, "ID1", "Ann", None, "Cole"), (1, "ID2", "Bo", "Cy", "Dee")], "n int, id string, first string, middle string, last string")
    rows = [(None, "Sgt Ann Q Cole saw B Cole"), (None, "Officers BC Dee and Cole ran"), (7, "Officer Dee"), (7, "Officer Dee"), (7, "Dee is not named here"), (None, None)]
    got = anonymize.anonymize(spark.createDataFrame(rows, "k int, text string"), names, "k", "text", "n")
    assert sorted(((r["k"], r["text"]) for r in got.collect()), key=str) == sorted([(None, "sgt ID1? saw b cole"), (None, "officers ID2 and ID1 ran"), (7, "officer ID2"), (7, "officer ID2"), (7, "dee is not named here"), (None, None)], key=str)
    empty = anonymize.anonymize(spark.createDataFrame([], "k int, text string"), names.limit(0), "k", "text", "n")
    assert empty.columns == ["k", "text"] and empty.count() == 0


def test_dummies_ignore_null(spark):
    levels = spark.createDataFrame([("bachelor",), (None,), ("highschool",)], "education string")
    assert matrix.dummies(levels, "education").agg(F.sum("is_highschool")).first()[0] == 1


def test_single_class_is_told(spark):
    assert not matrix.has_both_classes(spark.createDataFrame([(1,), (1,)], "outcome int"), "outcome")


def test_outcome_label_counts_null_as_nothing(spark):
    events = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "d int, e int")
    outcomes = spark.createDataFrame([(10, 2), (20, None)], "e int, n int")
    assert {r["d"]: r["y"] for r in event_features.outcome_label(events, outcomes, "d", "e", "n", "y").collect()} == {1: 1, 2: 0, 3: 0}


def test_archive_replace_append(spark, tmp_path):
    built = []
    build = lambda: built.append(1) or spark.range(3)
    for meta in ({"a": 1, "b": 2}, {"b": 2, "a": 1}):
        assert io.archived(spark, f"{tmp_path}/m", meta, build).count() == 3
    assert len(built) == 1
    rows = lambda *x: spark.createDataFrame(list(x), "model_id int, as_of_date string, value int")
    io.append(rows((1, "a", 1), (1, "b", 2)), f"{tmp_path}/e")
    io.replace(rows((1, "b", 5)), f"{tmp_path}/e")
    assert {(r["as_of_date"], r["value"]) for r in spark.read.parquet(f"{tmp_path}/e").collect()} == {("a", 1), ("b", 5)}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "id int, score double, pred int, label int")
    assert evaluate.global_metrics(none).count() == 6
    assert evaluate.cut_metrics(none).count() == 102
    assert evaluate.curve_metrics(none).filter("value is not null").count() == 0


def test_importances_leave_out_each_feature(spark, small):
    got = {tuple(r["subset"].split(",")) for r in reports.feature_importances(spark, small).select("subset").distinct().collect()}
    assert got == {tuple(f for f in reports.FEATURES if f != out) for out in reports.FEATURES}


def test_trailing_sums_against_pairs(spark):
    """Ties at either edge, repeated left rows, null keys, several spans."""
    import random

    rng = random.Random(4)
    at = lambda h: dt.datetime(2016, 1, 1) + dt.timedelta(hours=h)
    left = [(rng.randrange(30), rng.choice([1, 2, None]), at(rng.randrange(60))) for _ in range(50)]
    right = [(rng.choice([1, 2, None]), at(rng.randrange(60)), rng.randrange(9)) for _ in range(80)]
    l = spark.createDataFrame(left, "id int, e int, t timestamp_ntz")  # noqa: E741
    r = spark.createDataFrame(right, "e int, r timestamp_ntz, v int")
    spans = {"a": 3600, "b": 30 * 3600, "c": (0, 2)}
    length = {"a": dt.timedelta(hours=1), "b": dt.timedelta(hours=30), "c": dt.timedelta(days=2)}
    for closed in (True, False):
        got = {r["id"]: r.asDict() for r in banding.trailing_sums(l, r, ["id"], ["e"], "t", "r", spans, {"v": "v"}, closed).collect()}
        want = {}
        for i, e, t in left:
            row = want.setdefault(i, {"id": i, **{k: 0 for s in spans for k in (s, f"v_{s}")}})
            for f, u, v in right:
                for s in spans:
                    if e is not None and e == f and t - length[s] <= u and (u <= t if closed else u < t):
                        row[s] += 1
                        row[f"v_{s}"] += v
        assert got == {i: w for i, w in want.items() if any(w[s] for s in spans)}


def test_distinct_entities_in_a_band(spark):
    import random

    rng = random.Random(7)
    at = lambda h: dt.datetime(2016, 1, 1) + dt.timedelta(minutes=20 * h)
    left = [(i, at(rng.randrange(90))) for i in range(40)]
    right = [(rng.randrange(6), at(rng.randrange(90))) for _ in range(70)]
    got = banding.band_distinct_counts(spark.createDataFrame(left, "id int, t timestamp_ntz"), spark.createDataFrame(right, "e int, r timestamp_ntz"), "id", "e", "t", "r", {"a": 1200, "b": 7200})
    want = {i: (len({e for e, u in right if t - dt.timedelta(seconds=1200) <= u <= t}), len({e for e, u in right if t - dt.timedelta(seconds=7200) <= u <= t})) for i, t in left}
    assert {r["id"]: (r["a"], r["b"]) for r in got.collect()} == want


def test_guessed_initials_are_one_form(spark):
    """26 guessed initials are one row of the forms that texts are joined with, and the last person of an own and a guessed form counts."""
    rows = [(0, "ID1", "Ann", None, "Cole"), (1, "ID2", "Ann", "Bea", "Cole"), (2, "ID3", "Bo", "Cy", "Dee"), (3, "ID4", "Bo", None, "Dee"), (4, "ID5", None, None, "Fox"), (5, "ID6", "- -", "", "Gray")]
    names = spark.createDataFrame(rows, "n int, id string, first string, middle string, last string")
    assert anonymize.short_forms(names.filter("n = 0"), "n").count() == 4 and anonymize.name_forms(names.filter("n = 0"), "n").count() == 29
    texts = ["officer ann b cole", "officer ann q cole", "officer bo c dee", "officer ab cole", "officers bc dee and k fox and q gray", "officer a ? cole", "officer cole", "sgt ann é cole"]
    forms = {r["pattern"]: r["id"] for r in anonymize.name_forms(names, "n").collect()}
    got = {r["k"]: r["text"] for r in anonymize.anonymize(spark.createDataFrame(list(enumerate(texts)), "k int, text string"), names, "k", "text", "n").collect()}
    assert got == {k: _brute_anonymize(t, forms) for k, t in enumerate(texts)}
    assert got[0] == "officer ID2" and got[1] == "officer ID1?" and got[2] == "officer ID4?"


def test_badges_in_one_pass(spark):
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(["code", " no.", " number ", "#", "-", "(", ")", "1", "23", "4567", " ", "c", "\t", " "], 14)) for _ in range(3000)]
    want = texts
    for pattern in anonymize.BADGE_PATTERNS:
        want = [re.sub(pattern, anonymize.BADGE, t) for t in want]
    got = spark.createDataFrame(list(enumerate(texts)), "k int, t string").select("k", anonymize.scrub_badges(F.col("t")).alias("s"), anonymize.normalize_report(F.col("t")).alias("r")).collect()
    assert {r["k"]: r["s"] for r in got} == dict(enumerate(want))
    assert {r["k"]: r["r"] for r in got} == {k: re.sub(r"[ \t]+", " ", t).strip(" ") for k, t in enumerate(texts)}
