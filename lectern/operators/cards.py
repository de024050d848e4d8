"""Nested cards (a summary and a detail document each) to flat tables.

Numbers may be texts or numbers in the source, so they are read as text and parsed with their raw value and a warning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from lectern.functions.ids import legacy_id
from lectern.functions.numbers import parse_decimal, parse_int
from lectern.functions.text import bool_or_none, first_text, html_text, stripped
from lectern.operators.project import array_or, lines
from lectern.sources.files import write_csv

_PLACE = "struct<slug:string,code:string,title:string>"
SUMMARY = f"struct<slug:string,name:string,code:string,faculties:array<struct<slug:string,code:string,title:string,chairs:array<{_PLACE}>>>>"
_PROGRAM = "struct<id:string,code:string,name:string,enrol:string,place:string,description:string,discipline:array<string>,plan:string,practice:array<struct<name:string,url:string,image:string>>>"
_CHAIR = (
    "struct<slug:string,code:string,title:string,about:string,practice:string,phone:string,address:string,site:string,description:string,faculty:struct<slug:string,title:string>,"
    f"oldPoints:struct<points:array<struct<year:string,count:string>>>,educationalProgram:struct<items:array<{_PROGRAM}>>>"
)
DETAIL = (
    "struct<slug:string,additional:struct<name:string,code:string,qualification:string,scienceDegree:string,studyPeriod:string,military:string>,faculty:struct<slug:string,title:string>,"
    "points:array<struct<id:string,code:string,title:string,point:string,isChoice:string>>,"
    "price:array<struct<id:string,code:string,studyForm:string,term:string,value:string,discountValue:string,currency:string,urlDiscount:string,subtitle:string>>,"
    f"places:array<struct<id:string,code:string,title:string,count:string>>,courses:struct<items:array<string>>,specializations:array<string>,chairs:struct<items:array<{_CHAIR}>>>"
)


def read_cards(raw: DataFrame, summary: str = "summary", detail: str = "detail") -> DataFrame:
    """slug, s, d and departments from JSON texts; departments are the detail's, the summary's where it has none."""
    parsed = raw.select("*", F.from_json(summary, SUMMARY).alias("s"), F.from_json(detail, DETAIL).alias("d"))
    plain = F.flatten(F.transform(F.coalesce("s.faculties", F.array().cast(f"array<struct<slug:string,code:string,title:string,chairs:array<{_PLACE}>>>")), lambda f: F.coalesce(f["chairs"], F.array().cast(f"array<{_PLACE}>"))))
    names = ("about", "practice", "phone", "address", "site", "description")
    none = [F.lit(None).cast("string").alias(n) for n in names]
    rest = [F.lit(None).cast("struct<slug:string,title:string>").alias("faculty"), F.lit(None).cast("struct<points:array<struct<year:string,count:string>>>").alias("oldPoints"), F.lit(None).cast(f"struct<items:array<{_PROGRAM}>>").alias("educationalProgram")]
    wide = F.transform(plain, lambda c: F.struct(c["slug"].alias("slug"), c["code"].alias("code"), c["title"].alias("title"), *none, *rest))
    return parsed.withColumn("slug", first_text(F.col("s.slug"), F.col("d.slug"))).withColumn("departments", array_or(F.filter("d.chairs.items", lambda c: c.isNotNull()), wide))


def majors(cards: DataFrame) -> DataFrame:
    """One row a card: names, places and counts."""
    faculty = F.get("s.faculties", F.lit(0))
    size = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))
    return cards.select(
        legacy_id("card", "major", F.col("slug")).alias("id"), "slug", first_text(F.col("d.additional.name"), F.col("s.name")).alias("name"), first_text(F.col("d.additional.code"), F.col("s.code")).alias("code"),
        F.coalesce("d.additional.qualification", F.lit("")).alias("qualification"), bool_or_none(F.col("d.additional.military")).alias("military"),
        first_text(F.col("d.faculty.title"), faculty["title"]).alias("faculty_name"), size("departments").alias("n_departments"), size("d.points").alias("n_requirements"), size("d.price").alias("n_prices"),
    )


def _items(cards: DataFrame, items: Column | str) -> DataFrame:
    """slug, ordinal (place in the source, nulls counted) and item."""
    return cards.select("slug", F.posexplode(items).alias("ordinal", "x")).where("x is not null")


def _number(c: Column, name: str, parse=parse_int) -> list[Column]:
    return [parse(c)["value"].alias(name), c.alias(f"{name}_raw"), parse(c)["warning"].alias(f"{name}_warning")]


def entrance_subjects(cards: DataFrame) -> DataFrame:
    x = _items(cards, "d.points")
    return x.select("slug", "ordinal", legacy_id("card", "entrance-requirement", F.col("slug"), F.col("x.title"), F.col("ordinal")).alias("legacy_id"), F.col("x.title").alias("title"), *_number(F.col("x.point"), "point"), bool_or_none(F.col("x.isChoice")).alias("is_choice"))


def tuition(cards: DataFrame) -> DataFrame:
    x = _items(cards, "d.price")
    return x.select("slug", "ordinal", F.col("x.studyForm").alias("study_form"), F.col("x.term").alias("term"), *_number(F.col("x.value"), "value", parse_decimal), *_number(F.col("x.discountValue"), "discount", parse_decimal), F.col("x.currency").alias("currency"))


def departments(cards: DataFrame) -> DataFrame:
    x = _items(cards, "departments")
    return x.select(
        "slug", "ordinal", first_text(F.col("x.slug"), F.col("x.code"), F.col("x.title")).alias("department_key"), F.col("x.title").alias("title"), html_text("x.about").alias("about"), lines(html_text("x.description")).alias("realized_programs"),
        F.coalesce("x.faculty.title", F.lit("")).alias("faculty"),
    )


def historical_scores(cards: DataFrame) -> DataFrame:
    x = _items(cards, "departments").select("slug", F.col("x.slug").alias("department"), F.posexplode("x.oldPoints.points").alias("ordinal", "p"))
    return x.select("slug", "department", "ordinal", *_number(F.col("p.year"), "year"), *_number(F.col("p.count"), "count"))


def educational_programs(cards: DataFrame) -> DataFrame:
    x = _items(cards, "departments").select("slug", F.col("x.slug").alias("department"), F.posexplode("x.educationalProgram.items").alias("ordinal", "p")).where("p is not null")
    return x.select("slug", "department", "ordinal", first_text(F.col("p.id"), F.col("p.code"), F.col("p.name")).alias("program_key"), F.col("p.name").alias("name"), F.col("p.code").alias("code"), *_number(F.col("p.place"), "places"), F.coalesce("p.plan", F.lit("")).alias("plan_url"))


def disciplines(cards: DataFrame) -> DataFrame:
    """(scope, slug, owner, name): courses of cards, disciplines of programs."""
    courses = cards.select(F.lit("major").alias("scope"), "slug", F.col("slug").alias("owner"), F.explode("d.courses.items").alias("name"))
    special = cards.select(F.lit("department").alias("scope"), "slug", F.col("slug").alias("owner"), F.explode("d.specializations").alias("name"))
    nested = _items(cards, "departments").select("slug", F.explode("x.educationalProgram.items").alias("p")).select(F.lit("program").alias("scope"), "slug", first_text(F.col("p.id"), F.col("p.code"), F.col("p.name")).alias("owner"), F.explode("p.discipline").alias("name"))
    return courses.unionByName(special).unionByName(nested).where(stripped(F.col("name")) != "")


def study_plan_files(cards: DataFrame) -> DataFrame:
    """(plan_url, n_programs, programs): each plan address once, with the programs that name it."""
    named = educational_programs(cards).where("plan_url <> ''")
    return named.groupBy("plan_url").agg(F.count("*").alias("n_programs"), F.sort_array(F.collect_set("program_key")).alias("programs"))


def with_files(manifest: DataFrame, resolved: DataFrame) -> DataFrame:
    """Manifest rows with what their address was resolved to; an address is resolved once, and one that failed is a row with status error."""
    return manifest.join(resolved, "plan_url", "left").withColumn("plan_status", F.coalesce("plan_status", F.lit("error")))


def plan_manifest(cards: DataFrame, resolved: DataFrame) -> DataFrame:
    """A row for each program of each card that names a plan, with what its address was resolved to: `resolved` (plan_url, plan_status, resolved_url, local_path, size, sha256, mime_type)."""
    own = majors(cards).select(F.col("id").alias("major_id"), "slug", F.col("code").alias("major_code"), F.col("name").alias("major_name"))
    programs = educational_programs(cards).where("plan_url <> ''").select("slug", F.col("program_key").alias("program_id"), F.col("code").alias("program_code"), F.col("name").alias("program_name"), "plan_url")
    found = with_files(programs.join(own, "slug"), resolved)
    identity = legacy_id("card", "study-plan", F.col("major_id"), F.col("program_id"), F.col("plan_url")).alias("id")
    return found.select(
        identity, "local_path", "major_id", F.col("slug").alias("major_slug"), "major_code", "major_name", "program_id", "program_code", "program_name", "plan_url", "plan_status", F.col("plan_url").alias("source_url"), "resolved_url", "size", "sha256", "mime_type"
    )


def projections(cards: DataFrame, resolved: DataFrame) -> dict[str, DataFrame]:
    """The flat tables of cards by the names of their files."""
    flat = lambda df: df.select(*[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, ArrayType) else F.col(f.name) for f in df.schema])
    tables = {
        "majors": majors(cards), "departments": departments(cards), "educational_programs": educational_programs(cards), "entrance_subjects": entrance_subjects(cards), "tuition": tuition(cards),
        "disciplines": disciplines(cards), "historical_passing_scores": historical_scores(cards), "study_plan_files": plan_manifest(cards, resolved),
    }
    return {name: flat(df) for name, df in tables.items()}


def write_dataset(cards: DataFrame, resolved: DataFrame, path: str) -> None:
    """The eight tables of projections() as CSV folders with sorted headers, written by the tasks that hold them."""
    for name, df in projections(cards, resolved).items():
        write_csv(df, f"{path}/{name}.csv")
