from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fabula.functions import provenance, schema
from fabula.operators import ordered
from fabula.sources import app

SCHEMA = {
    "$defs": {
        "outcome": {"enum": ["annotated", "abstained"]},
        "abstain_reason": {"enum": ["too_short", "no_plot"]},
        "share": {"type": "number", "minimum": 0, "maximum": 1, "description": "a share"},
        "layers": {
            "type": "object", "required": ["structural_skeleton"], "title": "dropped",
            "properties": {"structural_skeleton": {"type": "object", "properties": {
                "emotional_arc": {"type": "string"}, "arc_points": {"type": "array", "minItems": 11}, "pattern": {"$ref": "#/$defs/share", "description": "its own words"},
            }}},
        },
        "beat_tags_block": {"type": "object", "properties": {"tags": {"type": "array", "minItems": 1, "items": {"enum": ["a", "b"], "default": "a"}}, "more": {"type": "array", "minItems": 2, "uniqueItems": True}}},
    }
}


def test_model_output_schema():
    s = schema.model_output(SCHEMA)
    assert s["required"] == ["outcome", "abstain_reason", "layers", "beat_tags"] and s["additionalProperties"] is False
    assert s["properties"]["abstain_reason"]["enum"] == ["too_short", "no_plot", None]
    layers, null = s["properties"]["layers"]["anyOf"]
    assert null == {"type": "null"} and "title" not in layers
    skeleton = layers["properties"]["structural_skeleton"]
    # the arc comes first, "pattern" is a property here and no keyword, words beside a reference win
    assert skeleton["required"] == ["arc_points", "arc_confidence", "pattern"] == list(skeleton["properties"])
    assert skeleton["properties"]["pattern"] == {"type": "number", "description": "its own words"}
    assert skeleton["properties"]["arc_points"]["required"] == [f"t{k:02d}" for k in range(11)]
    beats = s["properties"]["beat_tags"]["anyOf"][0]["properties"]
    assert beats == {"tags": {"type": "array", "minItems": 1, "items": {"enum": ["a", "b"]}}, "more": {"type": "array"}}
    assert "emotional_arc" in SCHEMA["$defs"]["layers"]["properties"]["structural_skeleton"]["properties"]  # the input is left as it was


def test_schema_that_refers_to_itself():
    with pytest.raises(ValueError):
        schema.expanded({"$ref": "#/$defs/a"}, {"a": {"items": {"$ref": "#/$defs/a"}}})


def test_owners_of_files(spark):
    rows = spark.createDataFrame([(False, None), (True, None), (True, "pairs"), (True, "pilot")], "found boolean, owner string")
    found, owner = F.col("found"), F.col("owner")
    got = rows.select(provenance.visible(found, owner), provenance.visible(found, owner, include_pairs=True), provenance.pairs_own(found, owner)).collect()
    assert [tuple(r) for r in got] == [(False, False, True), (True, True, False), (False, True, True), (True, True, False)]


def test_notes_are_cut(spark):
    one = spark.range(1)
    note = lambda effort, request: one.select(provenance.notes(F.lit(2), F.lit(effort), F.lit(7), F.lit(request))).first()[0]
    assert note("high", None) == "attempts=2; effort=high; cache_creation_input_tokens=7; request_id=None"
    long = note("x" * 600, "r")
    assert len(long) == provenance.MOST_NOTES and long.endswith("x...")
    assert one.select(provenance.clipped(F.lit("y" * 500), 500)).first()[0] == "y" * 500


def test_unheaded_season(spark):
    rows = [
        (1, 1, "Episodes", None), (1, 2, "Part II", None), (1, 3, "Specials", None), (1, 4, "2004", None), (1, 5, None, None), (1, 6, "Part 2 (2007)", None), (1, 7, "Partly", None),
        (2, 1, "Episodes", 1), (2, 2, "Season 3 (1991)", 1), (3, 1, "", 2), (4, 1, "List of episodes", 1),
    ]
    t = spark.createDataFrame(rows, "page int, n int, h string, seasons int")
    got = ordered.unheaded_season(t, "page", "n", "h", "seasons").orderBy("page", "place").collect()
    assert [(r.page, r.n, r.season, r.place) for r in got] == [(1, 1, 1, 1), (1, 2, 1, 2), (1, 5, 1, 3), (1, 6, 1, 4), (4, 1, 1, 1)]
    assert ordered.unheaded_season(t.limit(0), "page", "n", "h", "seasons").count() == 0


def test_app_tables(spark):
    app.create_tables(spark, "app_test")
    try:
        app.create_tables(spark, "app_test")  # again, nothing is lost or raised
        assert {r.tableName for r in spark.sql("SHOW TABLES IN app_test").collect()} == set(app.TABLES)
        assert spark.table("app_test.availability").columns == ["title_id", "service", "link", "last_seen", "country"]
    finally:
        spark.sql("DROP DATABASE app_test CASCADE")


def test_reasons_to_fetch_again(spark):
    from fabula.functions import staleness

    # nothing is known, and nothing but a current version is
    rows = spark.createDataFrame([(None,) * 11, ("Q1", "ok", None, "1.5.9", "tv_series", None, None, 9, None, None, None), ("Q1", "ok", None, "1.x", "movie", None, "episode_table", 9, None, None, [(None,)])], staleness.FILE)
    got = [r[0] for r in rows.select(staleness.fetch_reasons({}, (), ())).collect()]
    assert got == [["current_ingest"], [], ["current_ingest", "episode_marker"]]
    # of two versions the later one counts, by number and not by text
    file = ("Q1", "ok", None, "1.5.10", "tv_series", "seasons", None, 9, None, None, None)
    one = spark.createDataFrame([file], staleness.FILE)
    assert one.select(staleness.fetch_reasons({"Q1": "1.5.12"}, (), ())).first()[0] == ["run_rule"]
    assert one.select(staleness.fetch_reasons({"Q1": "1.5.9"}, (), ())).first()[0] == []
