"""Materialisation, graph, report, aliases and cards on the domain's fixtures."""

import json

from pyspark.sql import functions as F

from lectern.operators import cards
from lectern.plans import canonical

PROVENANCE = "provenance struct<source_key:string,source_url:string,raw_snapshot_path:string>"
P = ("k", "https://example.com/x", "raw/x.json")


def test_programs_and_directions(spark):
    rows = [(1, "p1", "A", "01", "math", "Mathematics", "", P), (2, "p2", "B", "02", "math", "Other", "", P), (3, "", "C", "03", "", "", "", P)]
    df = spark.createDataFrame(rows, f"pos int, source_key string, name string, code string, study_direction_key string, study_direction_name string, study_direction_code string, {PROVENANCE}")
    programs, directions = canonical.programs(df, "u", ["pos"])
    assert {(r.name, r.code) for r in directions.collect()} == {("Mathematics", "math"), ("03", "03")}
    ids = {r.id for r in directions.collect()}
    assert {r.study_direction_id for r in programs.collect()} == ids
    off, _ = canonical.programs(df, "u", ["pos"], {"study_direction": False})
    assert {r.study_direction_id for r in off.collect()} == {""}
    assert {(r.field, r.source_key) for r in canonical.unresolved_references(off, "u").collect()} == {("study_direction_id", "math"), ("study_direction_id", "03")}


def test_curricula(spark):
    schema = f"pos int, curriculum_key string, code string, discipline string, name string, department string, section_path string, semester string, total_hours double, credits double, components map<string,double>, semester_loads {canonical.LOADS}, {PROVENANCE}"
    rows = [
        (1, "c", "1", "Algebra", None, "", "", "1", 72.0, 2.0, None, None, P),
        (2, "c", "2", None, "Physics", "", "", "x", None, None, {"a": 10.0, "b": 5.0}, [("1", None, 1.0, {"a": 4.0}), ("2", None, 2.0, None), ("0", 1.0, None, None)], P),
        (3, "c", "3", "", "Dropped", "", "", "1", 1.0, None, None, None, P),
        (4, "c", "1", "Algebra", None, "", "", "2", None, 4.0, None, None, P),
        (5, "c", "4", "Law", None, "", "", "1.0", None, None, None, None, P),
    ]
    got = canonical.curricula(spark.createDataFrame(rows, schema), "u", ["pos"])
    found = {(r.name, r.semester): r for r in got["disciplines"].collect()}
    assert len(found) == 4 and len({r.id for r in found.values()}) == 4
    assert (found["Algebra", "1"].total_hours, found["Algebra", "1"].hours_status) == (72.0, "published")
    assert (found["Algebra", "2"].total_hours, found["Algebra", "2"].hours_confidence) == (144.0, 0.7)
    assert (found["Physics", "x"].total_hours, found["Physics", "x"].hours_method) == (15.0, "sum_components")
    assert found["Law", "1.0"].hours_status == "not_published"
    loads = sorted((r.number, r.hours) for r in got["semester_loads"].collect() if r.hours)
    assert loads == [(1, 4.0), (1, 72.0), (2, 15.0), (2, 144.0)]
    assert sorted(r.number for r in got["semesters"].collect()) == [1, 2]
    records = {"disciplines": ("discipline", got["disciplines"]), "semesters": ("semester", got["semesters"]), "semester_loads": ("semester_load", got["semester_loads"])}
    objects, links, broken = canonical.ontology(records, "u", {"curriculum": False})
    assert objects.count() == 4 + 2 + 5
    assert {r.type for r in broken.collect()} == {"scope"}  # the university itself isn't among the records
    assert links.groupBy("type").count().orderBy("type").collect() == [("discipline_id", 5), ("semester_id", 5)]
    frames = {n: df for n, (_, df) in records.items()}
    report = canonical.quality_report(frames, "u", {"curricula": True, "teachers": False}, {"curricula": "disciplines"})
    assert report["passed"] and report["capability_status"] == {"curricula": "published", "teachers": "not_supported"}
    bad = canonical.quality_report({"d": got["semesters"].unionByName(got["semesters"]).withColumn("scope", F.lit("v"))}, "u", {"d": True, "e": True, "f": True}, {}, broken, {"f": "degraded"}, ["f"])
    assert bad["errors"] == ["e: no records", "records_scoped", "record_ids_unique", f"{broken.count()} orphan links"]
    assert bad["capability_status"]["f"] == "degraded"


def test_aliases(spark):
    old = spark.createDataFrame([("t", "old1", "HTTP://H/a"), ("t", "same", "k2"), ("t", "old3", "")], "entity_type string, id string, source_key string")
    new = spark.createDataFrame([("t", "new1", "http://h/a#x", ["l1"]), ("t", "same", "K2", []), ("t", "new3", "", ["l1"])], "entity_type string, id string, source_key string, legacy_ids array<string>")
    aliases, conflicts = canonical.id_aliases(old, new, spark.createDataFrame([("t", "older", "old1")], "entity_type string, legacy_id string, canonical_id string"))
    assert {(r.legacy_id, r.canonical_id) for r in aliases.collect()} == {("old1", "new1"), ("older", "old1")}
    assert [r.legacy_id for r in conflicts.collect()] == ["l1"]


def test_cards(spark):
    summary = {"slug": "s1", "name": "Sum", "code": "01", "faculties": [{"slug": "f", "title": "Fac", "chairs": [{"slug": "c0", "title": "Chair"}]}]}
    chair = {
        "slug": "c1", "title": "Dep", "about": "<p>About&nbsp;us</p>", "description": "one;\n; two \n", "oldPoints": {"points": [{"year": 2020, "count": "250"}, {"year": "x", "count": None}]},
        "educationalProgram": {"items": [{"id": "p1", "name": "Prog", "place": "40", "discipline": ["D1", " "], "plan": "http://x/plan"}, {"id": "p2", "name": "Two", "plan": "http://x/plan"}]},
    }
    detail = {"additional": {"name": "Full", "military": "да"}, "points": [{"title": "Math", "point": 40, "isChoice": "нет"}, None, {"title": "Rus", "point": "неизвестно"}], "price": [{"value": "699 000", "studyForm": "full"}], "courses": {"items": ["C1"]}, "chairs": {"items": [chair]}}
    df = spark.createDataFrame([(json.dumps(summary), json.dumps(detail)), (json.dumps(summary | {"slug": "s2"}), None)], "summary string, detail string")
    read = cards.read_cards(df)
    majors = {r.slug: r for r in cards.majors(read).collect()}
    assert (majors["s1"].name, majors["s1"].military, majors["s1"].n_departments, majors["s2"].name, majors["s2"].faculty_name) == ("Full", True, 1, "Sum", "Fac")
    subjects = {r.title: r for r in cards.entrance_subjects(read).collect()}
    assert (subjects["Math"].point, subjects["Math"].is_choice, subjects["Rus"].ordinal, subjects["Rus"].point, subjects["Rus"].point_raw) == (40, False, 2, None, "неизвестно")
    assert float(cards.tuition(read).first().value) == 699000
    departments = {r.department_key: r for r in cards.departments(read).collect()}
    assert (departments["c1"].about, departments["c1"].realized_programs, departments["c0"].title) == ("About us", ["one", "two"], "Chair")
    assert [(r.year, r["count"]) for r in cards.historical_scores(read).collect()] == [(2020, 250), (None, None)]
    assert {(r.scope, r.name) for r in cards.disciplines(read).collect()} == {("major", "C1"), ("program", "D1")}
    files = cards.study_plan_files(read).first()
    assert (files.n_programs, files.programs) == (2, ["p1", "p2"])
