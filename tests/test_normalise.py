import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from firnspark.functions import codes
from firnspark.operators import normalise as N
from firnspark.sources import bulletins as B


def caic(**changes):
    document = {
        "type": "avalancheforecast",
        "expiryDateTime": "2023-11-05T16:30:00Z",
        "issueDateTime": "2023-11-05T01:30:00.000Z",
        "areaId": "a1",
        "title": None,
        "polygons": ["p1", "p2"],
        "avalancheSummary": {"days": [{"content": "first"}]},
        "dangerRatings": {"days": [{"alp": "high", "tln": "odd", "btl": ""}]},
        "avalancheProblems": {
            "days": [
                [
                    {},
                    {
                        "type": "dryLoose",
                        "likelihood": "possible_likely",
                        "expectedSize": {"min": "1.5", "max": 2},
                        "aspectElevations": ["n_alp", "n_alp", "ne_alp", "cliff_alp", "s_btl"],
                    },
                    None,
                    {
                        "type": "glide",
                        "likelihood": "certain",
                        "expectedSize": {"min": 1, "max": 1},
                        "aspectElevations": [],
                    },
                ],
                [],
            ]
        },
    }
    return document | changes


def nwac(**changes):
    document = {
        "product_type": "Forecast",
        "published_time": "2024-01-02T03:00:00+00:00",
        "updated_at": "2024-01-02T03:30:00.1239+00:00",
        "bottom_line": "",
        "hazard_discussion": "talk",
        "danger": [
            {"valid_day": "tomorrow", "upper": 5, "middle": 5, "lower": 5},
            {"valid_day": "current", "upper": 3, "middle": 2, "lower": None},
        ],
        "forecast_avalanche_problems": [
            {"rank": 2, "avalanche_problem_id": 4, "likelihood": "almost certain", "size": ["1", 2.5], "location": ["northeast upper"]},
            {"rank": 2, "avalanche_problem_id": 3, "likelihood": "likely", "size": [1, 2], "location": ["south lower", "west lower"]},
        ],
        "forecast_zone": [
            {"id": 9, "name": "Elsewhere", "zone_id": "z1"},
            {"id": 10, "name": "Mt Hood", "zone_id": "z2"},
        ],
    }
    return document | changes


def documents(spark, center, *docs):
    texts = spark.createDataFrame([(json.dumps(d),) for d in docs], "document string")
    return B.parse_documents(texts, center)


def rows(spark, center, *docs, **options):
    return [r.asDict() for r in N.normalise(documents(spark, center, *docs), center, **options).collect()]


def test_caic_days_and_slots(spark):
    first, second = sorted(rows(spark, "CAIC", caic(), caic(type="other")), key=lambda r: r["forecast_days_out"])
    assert (first["region_id"], first["area_name"], first["polygons"]) == ("CAIC.a1", "undefined", "p1,p2")
    assert first["distribution_date"] == dt.date(2023, 11, 5) and second["forecast_date"] == dt.date(2023, 11, 6)
    assert (first["avalanche_summary"], second["avalanche_summary"]) == ("first", "")
    assert (first["danger_alp"], first["danger_tln"], first["danger_btl"]) == (4, 0, 0)
    assert (first["problem_type_0"], first["problem_type_1"], first["problem_type_2"]) == (0, 1, 0)
    assert (first["likelihood_1"], first["min_size_1"], first["max_size_1"]) == (2, 1.5, 2.0)
    assert (first["n_alp_1"], first["ne_alp_1"], first["s_btl_1"], first["e_alp_1"]) == (1, 1, 1, 0)
    # Repeated names count once, names that are no flag still count.
    assert (first["alp_prevalence_1"], first["btl_prevalence_1"], first["prevalence_1"]) == (3, 1, 4)
    assert second["problem_type_1"] == 0 and second["danger_alp"] == 0


def test_caic_autumn_overlap_is_read_as_standard_time(spark):
    (first, *_) = rows(spark, "CAIC", caic())
    assert first["publish_datetime"].astimezone(dt.UTC).replace(tzinfo=None) == dt.datetime(2023, 11, 5, 8, 30)


def test_caic_without_days_gives_no_rows(spark):
    assert rows(spark, "CAIC", caic(dangerRatings={"days": []}, avalancheProblems={"days": []})) == []


def test_caic_ratings_longer_than_problems(spark):
    ratings = {"days": [{"alp": "low"}] * 3}
    assert len(rows(spark, "CAIC", caic(dangerRatings=ratings))) == 3


@pytest.mark.parametrize(
    "changes, message",
    [
        ({"expiryDateTime": "soon"}, "bad expiry time"),
        ({"areaId": None}, "missing region_id"),
        ({"avalancheProblems": {"days": [[{"type": "icefall", "likelihood": "likely", "expectedSize": {"min": 1, "max": 1}, "aspectElevations": []}]]}}, "unknown problem type"),
        ({"avalancheProblems": {"days": [[{"type": "glide", "likelihood": "odd", "expectedSize": {"min": "big", "max": 1}, "aspectElevations": []}]]}}, "unknown likelihood; bad size"),
    ],
)
def test_caic_errors(spark, changes, message):
    bad = caic(**changes)
    with pytest.raises(Exception, match=message):
        rows(spark, "CAIC", bad)
    checked = N.normalise(documents(spark, "CAIC", caic(), bad), "CAIC", mode="quarantine")
    good, wrong = N.split_quarantine(checked)
    assert good.count() == 2
    assert all(message in "; ".join(r[N.ERRORS]) for r in wrong.collect()) and wrong.count() > 0


def test_document_without_type_stops_the_job(spark):
    with pytest.raises(Exception, match="no product type"):
        rows(spark, "CAIC", caic(type=None))


def test_nwac_row(spark):
    (row,) = rows(spark, "NWAC", nwac(), nwac(product_type="warning"))
    assert row["distribution_date"] == row["forecast_date"] == dt.date(2024, 1, 1)
    assert row["publish_datetime"].microsecond == 123000
    assert (row["region_id"], row["area_name"], row["polygons"]) == ("NWAC.1140", "Mt Hood", "z2")
    assert row["avalanche_summary"] == "talk"
    assert (row["danger_alp"], row["danger_tln"], row["danger_btl"]) == (3, 2, 0)
    # The later problem of a rank wins, flags are united, the prevalence is the winner's.
    assert (row["problem_type_0"], row["problem_type_1"], row["likelihood_1"], row["max_size_1"]) == (0, 3, 3, 2.0)
    assert (row["ne_alp_1"], row["s_btl_1"], row["w_btl_1"]) == (1, 1, 1)
    assert (row["alp_prevalence_1"], row["btl_prevalence_1"], row["prevalence_1"]) == (0, 2, 2)


def test_nwac_all_zones(spark):
    found = rows(spark, "NWAC", nwac(), zones="all")
    assert sorted(r["region_id"] for r in found) == ["NWAC.1140", "NWAC.9"]


def test_nwac_errors(spark):
    with pytest.raises(Exception, match="missing region_id"):
        rows(spark, "NWAC", nwac(forecast_zone=[]))
    with pytest.raises(Exception, match="no current danger"):
        rows(spark, "NWAC", nwac(danger=[]))
    (row,) = rows(spark, "NWAC", nwac(danger=[]), mode="lenient")
    assert row["danger_alp"] == 0


def test_unknown_center(spark):
    with pytest.raises(ValueError, match="unsupported"):
        N.normalise(documents(spark, "CAIC", caic()), "ELSE")


def test_scan_of_array_files(spark, tmp_path):
    (tmp_path / "2023-11-05.json").write_text(json.dumps([caic(), caic(areaId="a2")], indent=2))
    (tmp_path / "2023-11-06.json").write_text("[{broken")
    scanned = B.scan_documents(spark, "CAIC", str(tmp_path))
    assert scanned.where("areaId IS NOT NULL").select("landed_date").distinct().first()[0] == dt.date(2023, 11, 5)
    assert len(B.corrupt_documents(scanned).collect()) == 1
    with pytest.raises(Exception, match="unreadable"):
        N.normalise(scanned, "CAIC").collect()
    (tmp_path / "2023-11-06.json").write_text("[]")
    assert N.normalise(B.scan_documents(spark, "CAIC", str(tmp_path)), "CAIC").count() == 4


def test_landing_replaces_days(spark, tmp_path):
    path = str(tmp_path / "landing")
    for area in ("a1", "a2"):
        docs = documents(spark, "CAIC", caic(areaId=area)).selectExpr("*", "date '2023-11-05' AS distribution_date")
        B.land_documents(docs, path)
    scanned = B.scan_documents(spark, "CAIC", path, lines=True)
    assert [(r.areaId, r.landed_date) for r in scanned.collect()] == [("a2", dt.date(2023, 11, 5))]


@pytest.mark.parametrize("center, document", [("CAIC", caic()), ("NWAC", nwac())])
def test_texts_are_parsed_once(spark, center, document):
    texts = spark.createDataFrame([(1, json.dumps(document)), (2, None)], "k int, document string")
    parsed = B.parse_documents(texts, center, keep=("k",))
    assert {row.k: all(value is None for value in row[1:]) for row in parsed.collect()} == {1: False, 2: True}
    good, _ = N.split_quarantine(N.normalise(parsed, center, mode="quarantine", keep=("k",)))
    assert good.count() == len(rows(spark, center, document))
    # The plan names the parser once for every time that it runs.
    assert good._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_landed_lines_are_compressed(spark, tmp_path):
    docs = documents(spark, "CAIC", caic()).selectExpr("*", "date '2023-11-05' AS distribution_date")
    B.land_documents(docs, str(tmp_path / "landing"))
    landed = [file for file in (tmp_path / "landing").rglob("part-*")]
    assert landed and all(file.name.endswith(".json.gz") for file in landed)


def test_problems_beyond_the_slots_are_checked(spark):
    good = {"type": "glide", "likelihood": "likely", "expectedSize": {"min": 1, "max": 1}, "aspectElevations": []}
    for place in range(6):
        problems = [good | ({"type": "icefall", "likelihood": "odd"} if i == place else {}) for i in range(6)]
        bad = caic(avalancheProblems={"days": [problems]}, dangerRatings={"days": []})
        (row,) = rows(spark, "CAIC", bad, mode="quarantine")
        assert row[N.ERRORS] == ["unknown problem type", "unknown likelihood"]
        assert row["problem_type_2"] == (9 if place != 2 else 0)
    with pytest.raises(Exception, match="unknown likelihood"):
        rows(spark, "CAIC", bad)


def test_codes_are_found_in_lists(spark):
    odd = [None, "", ",", "low,moderate", "LOW", "dryLoose", "cornice", "veryLikely_almostCertain", "_", "certain_x", "very likely"]
    names = spark.createDataFrame([(name,) for name in odd], "name string")
    kinds = {"risk": codes.risk_code, "problem": codes.problem_code, "ranged": codes.likelihood_code_ranged, "spaced": codes.likelihood_code_spaced}
    found = {row.name: tuple(row[kind] for kind in kinds) for row in names.select("name", *[f("name").alias(k) for k, f in kinds.items()]).collect()}
    none = {name: (0, None, None, None) for name in odd}
    wanted = none | {"LOW": (1, None, None, None), "dryLoose": (0, 1, None, None), "cornice": (0, 8, None, None)}
    wanted |= {"veryLikely_almostCertain": (0, None, 4, None), "certain_x": (0, None, 5, None), "very likely": (0, None, None, 4)}
    assert found == wanted
    with pytest.raises(ValueError, match="comma"):
        codes.place_among(["a,b"], F.col("name"))


@pytest.mark.parametrize("center, document", [("CAIC", caic()), ("NWAC", nwac())])
def test_names_are_not_looked_up_in_maps(spark, center, document):
    """A map's keys are compared one by one in every lambda that looks one up."""
    checked = N.normalise(documents(spark, center, document), center, mode="quarantine")
    plan = checked.drop("area_id", "region_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "keys: [NOFORECAST" not in plan and "keys: [n_alp" not in plan
