"""Tokens and classifiers of curriculum tables; word lists are parameters with the usual ones as defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.text import ordered_tokens

#: Control tokens and what they mean (fixed values).
CONTROL_KINDS = {
    "ДЗчт": "graded_credit",
    "РЭкз": "rated_exam",
    "Зчт": "credit",
    "Экз": "exam",
    "ГЭК": "state_attestation",
    "КуР": "coursework",
    "КуП": "course_project",
    "ЭК": "other_control",
}
CONTROL_PATTERN = "(?iu)(?:" + "|".join(CONTROL_KINDS) + ")"
#: Words that mark kinds of rows (fixed values).
CYCLE, MANDATORY, ELECTIVE = ("дисциплины (модули)",), ("обязательн",), ("вариативн", "по выбору", "электив", "факультатив")


def control_tokens(c: Column, pattern: str = CONTROL_PATTERN) -> Column:
    return ordered_tokens(c, pattern)


def control_kinds(tokens: Column, kinds: dict[str, str] | None = None) -> Column:
    """What the tokens mean, each once, unknown ones left out."""
    table = F.create_map(*[F.lit(x) for k, v in (kinds or CONTROL_KINDS).items() for x in (k.lower(), v)])
    return F.array_distinct(F.filter(F.transform(tokens, lambda t: F.element_at(table, F.lower(t))), lambda x: x.isNotNull()))


def contains_any(c: Column, words: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(c, F.lit(w))
    return out


def row_kind(first: Column, name: Column, cycle=CYCLE, mandatory=MANDATORY, elective=ELECTIVE) -> Column:
    """discipline (a number in front), cycle, mandatory_group, elective_group, section or empty, tested in this order."""
    low = F.lower(F.coalesce(name, F.lit("")))
    return (
        F.when(F.coalesce(first, F.lit("")).rlike(r"^\d+$"), "discipline")
        .when(contains_any(low, cycle), "cycle")
        .when(contains_any(low, mandatory), "mandatory_group")
        .when(contains_any(low, elective), "elective_group")
        .when((low != "") | (F.coalesce(first, F.lit("")) != ""), "section")
        .otherwise("empty")
    )


def part_type(name: Column, mandatory=MANDATORY, elective=ELECTIVE) -> Column:
    """elective is tested before mandatory; null if neither."""
    low = F.lower(F.coalesce(name, F.lit("")))
    return F.when(contains_any(low, elective), "elective").when(contains_any(low, mandatory), "mandatory")


def semester_headers(c: Column) -> Column:
    """(number, weeks) of every "N - W weeks" heading in a text."""
    pattern = r"(?iuU)(?:(?:семестр)\s*)?(\d+)\s*[-–—]\s*(\d+)\s*недель"
    pairs = F.arrays_zip(F.regexp_extract_all(c, F.lit(pattern), 1).alias("number"), F.regexp_extract_all(c, F.lit(pattern), 2).alias("weeks"))
    return F.transform(pairs, lambda p: F.struct(p["number"].cast("int").alias("number"), p["weeks"].cast("int").alias("weeks")))


def table_class(columns: Column, left: Column) -> Column:
    """What a table is by its number of columns, or by its left edge: curriculum (60 or more), calendar_schedule (25 or more), time_budget_summary (10 or fewer, or far to the right), else other."""
    return F.when(columns >= 60, "curriculum").when(columns >= 25, "calendar_schedule").when((columns <= 10) | (left >= 700), "time_budget_summary").otherwise("other")
