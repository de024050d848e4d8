"""The curriculum grid end to end."""

from lectern.plans import curriculum

TABLES = "table_id string, document_id string, page_number int, ordinal int, section string, x0 double, x1 double"
CELLS = "table_id string, row_index int, column_index int, cell_id string, text string, x0 double, x1 double, word_ids array<string>"
WORDS = "document_id string, page_number int, word_id string, text string, x0 double, x1 double, top double"


def grid(spark, data_rows, words=()):
    head = [(0, ["Шифр", "Наименование", "Кафедра"], 0, 5), (2, ["Общая, з.е.", "Общая, час", "Аудит. час", "Лек", "Сем", "Лаб", "Сам"], 15, 5), (0, ["1 - 17 недель", "2 - 17 недель"], 50, 25)]
    cells = [("t", r, 10 * r + i + int(x), f"c{r}-{x + i * w}", text, float(x + i * w), float(x + (i + 1) * w), []) for r, texts, x, w in head for i, text in enumerate(texts)]
    for r, texts in data_rows:
        cells += [("t", r, i, f"c{r}-{i}", text, 5.0 * i, 5.0 * i + 5, [w[2] for w in words if w[-1] == r and 5.0 * i <= w[4] < 5.0 * i + 5]) for i, text in enumerate(texts)]
    tables = spark.createDataFrame([("t", "d", 1, 0, "curriculum", 0.0, 100.0), ("u", "e", 1, 0, "curriculum", None, None)], TABLES)
    cells = spark.createDataFrame([*cells, ("u", 5, 0, "x", "1", 0.0, 1.0, [])], CELLS)
    return tables, cells, spark.createDataFrame([w[:-1] for w in words], WORDS)


def test_grid(spark):
    rows = [
        (4, ["", "Обязательная часть"] + [""] * 18),
        (5, ["1", "Алгебра", "Кафедра", "2", "72", "36", "0", "0", "0", "36"] + ["2", "72", "36", "36", "Экз"] + [""] * 5),
        (6, ["", "По выбору"] + [""] * 18),
        (7, ["2", "Физика", "", "1,5", "54", "", "", "", "", ""] + [""] * 5 + ["1,5", "54", "", "", "Зчт"]),
    ]
    tables, cells, words = grid(spark, rows)
    schemas = curriculum.discover_schemas(tables, cells)
    s = schemas.first()
    assert (s.document_id, s["start"], s["count"], s.weeks) == ("d", 0.5, 2, {1: 17, 2: 17})
    assert (s.spans["name"].left, s.spans["name"].right) == (0.05, 0.1)
    assert set(s.spans) == set(curriculum.HEADINGS)
    found = curriculum.semantic_rows(curriculum.band_texts(tables, cells, words, schemas))
    kinds = {(r.table_id, r.row_index): r for r in found.collect()}
    assert [kinds["t", i].row_kind for i in (4, 5, 6, 7)] == ["mandatory_group", "discipline", "elective_group", "discipline"]
    assert kinds["u", 5].row_kind == "unresolved_schema"
    assert [kinds["t", i].part_type for i in (5, 7)] == ["mandatory", "elective"]
    assert kinds["t", 7].section_path == "Обязательная часть > По выбору"
    assert (kinds["t", 5].total_credits, kinds["t", 5].total_hours, kinds["t", 7].total_credits) == (2.0, 72.0, 1.5)
    loads = {(r.code, r.semester): r for r in curriculum.semester_loads(curriculum.disciplines(found)).collect()}
    assert set(loads) == {(c, n) for c in ("1", "2") for n in (1, 2)}
    assert (loads["1", 1].credits, loads["1", 1].hours, loads["1", 1].control_kinds, loads["1", 1].weeks) == (2.0, 72.0, ["exam"], 17)
    assert (loads["1", 2].active, loads["1", 2].has_numeric_load, loads["2", 2].control_tokens) == (False, False, ["Зчт"])


def test_control_words_go_by_their_left_edge(spark):
    texts = ["1", "Алгебра"] + [""] * 18
    words = [("d", 1, "w1", "1", 1.0, 2.0, 10.0, 4), ("d", 1, "w2", "Алгебра", 6.0, 9.0, 10.0, 4), ("d", 1, "w3", "72", 56.0, 58.0, 10.0, 4), ("d", 1, "w4", "Экз", 74.0, 77.5, 10.0, 4)]
    tables, cells, words = grid(spark, [(4, texts)], words)
    schemas = curriculum.discover_schemas(tables, cells)
    loads = {r.semester: r for r in curriculum.semester_loads(curriculum.disciplines(curriculum.semantic_rows(curriculum.band_texts(tables, cells, words, schemas)))).collect()}
    assert loads[1].control == "Экз" and loads[2].control_tokens == []
    assert loads[1].hours == 72.0
    assert loads[1].normalization_notes == ["control_reassigned_by_word_start"]
    assert loads[2].normalization_notes == ["control_token_removed_from_credits"]
