import os

import pytest

from jobloom.plans.questions import clean_questions
from jobloom.schemas import BRONZE_JOBS
from jobloom.sources import jobs, questions, tables


def put(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode())


def test_question_csv_rules(spark, tmp_path):
    root = str(tmp_path)
    put(f"{root}/a.csv", "﻿ Question ,Topic\n\"What is, a\nlist?\",\nWhy?,hr\nNA,x\n")
    put(f"{root}/b.csv", "id,questions\n1,Qué?\n2, Why? \n".encode("latin-1"))
    put(f"{root}/c.csv", "ID,DESCRIPTION\n1,What is padding\n")
    put(f"{root}/Behavioral_x.csv", "question\nTell me\n")
    put(f"{root}/notes.txt", "question\nnot a csv\n")
    with pytest.warns(UserWarning, match="c.csv"):
        raw = questions.read_question_csvs(spark, root)
    got = sorted((r["question"] or "", r["topic"], r["source"]) for r in raw.collect())
    assert got == [("", "x", "a.csv"), (" Why? ", "technical", "b.csv"),
                   ("Qué?", "technical", "b.csv"), ("What is, a\nlist?", "technical", "a.csv"),
                   ("Why?", "hr", "a.csv")]
    kept = clean_questions(raw, questions.row_order())
    assert sorted(r["question"] for r in kept.collect()) == ["Qué?", "What is, a\nlist?", "Why?"]


def test_first_of_equal_questions_by_file_then_row(spark, tmp_path):
    root = str(tmp_path)
    put(f"{root}/b.csv", "question,topic\nsame,tech b\n")
    put(f"{root}/a.csv", "question,topic\nother,tech\nsame,tech a1\nsame,tech a2\n")
    kept = clean_questions(questions.read_question_csvs(spark, root), questions.row_order())
    assert {r["question"]: r["topic"] for r in kept.collect()} == {
        "other": "tech", "same": "tech a1"}


def test_other_column_names(spark, tmp_path):
    put(f"{tmp_path}/c.csv", "ID,DESCRIPTION\n1, What is padding\n")
    raw = questions.read_question_csvs(spark, str(tmp_path), candidates=("description",))
    kept = clean_questions(raw, questions.row_order())
    assert [r["question"] for r in kept.collect()] == ["What is padding"]


def test_no_usable_file_is_an_error(spark, tmp_path):
    put(f"{tmp_path}/c.csv", "ID,DESCRIPTION\n1,What is padding\n")
    with pytest.warns(UserWarning), pytest.raises(FileNotFoundError):
        questions.read_question_csvs(spark, str(tmp_path))


def test_only_files_with_line_ends_in_quotes_are_read_whole(spark, tmp_path):
    put(f"{tmp_path}/a.csv", 'question\n"x\ny"\n')
    put(f"{tmp_path}/b.csv", 'question\n"say ""hi"""\n')
    layout = {r["source"]: r["spans"] for r in questions._survey(
        spark, str(tmp_path), "*.csv").collect()}
    assert layout == {"a.csv": True, "b.csv": False}
    got = sorted(r["question"] for r in questions.read_question_csvs(spark, str(tmp_path)).collect())
    assert got == ['say "hi"', "x\ny"]


def test_file_with_too_many_cells_is_skipped(spark, tmp_path):
    put(f"{tmp_path}/a.csv", 'question,topic\nfine,tech\nWhy, oh why,tech,\nx,y,z\n')
    put(f"{tmp_path}/b.csv", 'question,topic\n"quoted, but fine",tech\n')
    with pytest.warns(UserWarning, match="too many cells"):
        raw = questions.read_question_csvs(spark, str(tmp_path))
    assert [r["question"] for r in raw.collect()] == ["quoted, but fine"]


def test_question_lists(spark, tmp_path):
    put(f"{tmp_path}/dl.txt", "1. What is padding\nheading\n 12.  Why?  \n")
    put(f"{tmp_path}/ml.txt", "S.No\tQuestions\n1\tWhat are MSE and RMSE\n")
    numbered = questions.read_numbered_text(spark, f"{tmp_path}/dl.txt")
    assert [r["question"] for r in numbered.collect()] == ["What is padding", "Why?"]
    tabbed = questions.read_tabbed_text(spark, f"{tmp_path}/ml.txt")
    assert [r["question"] for r in tabbed.collect()] == ["What are MSE and RMSE"]


def test_html_lists(spark, tmp_path):
    put(f"{tmp_path}/a.html", "<p>intro</p><ul><LI class='x'>What is <b>SQL</b>?</li>\n"
        "<li> Why? <li></ul><ol><li>Open</ol>after")
    got = questions.read_html_lists(spark, str(tmp_path)).orderBy("line").collect()
    assert [r["question"] for r in got] == ["What is SQL ?", "Why?", "Open"]
    assert {r["source"] for r in got} == {"a.html"}


def test_newest_snapshot(spark, tmp_path):
    line = '{"question": "%s", "source": "s", "topic": "technical"}\n'
    put(f"{tmp_path}/interview_raw_20251205_220439.jsonl", line % "old 👶")
    put(f"{tmp_path}/interview_raw_20251206_000000.jsonl", line % "new 👶")
    snapshots = questions.read_snapshots(spark, f"{tmp_path}/*.jsonl")
    assert snapshots.count() == 2
    newest = questions.latest_snapshot(snapshots).first()
    assert newest["question"] == "new 👶"
    assert newest["snapshot"] == "interview_raw_20251206_000000.jsonl"


def test_pages_to_bronze_and_back(spark, tmp_path):
    put(f"{tmp_path}/in/p1.json", """{"count": 3, "results": [
      {"id": 7, "title": "Dev", "company": {"display_name": "A"}, "salary_min": 1},
      {"id": "7", "title": "again"}, {"title": "no id"}]}""")
    put(f"{tmp_path}/in/p2.json", '{"results": [{"id": 8, "category": {"label": "IT"}}, {"id": 7}]}')
    landed = jobs.land_jobs(jobs.read_pages(spark, f"{tmp_path}/in"))
    jobs.write_bronze(landed, f"{tmp_path}/bronze", "2024-01-04")
    jobs.write_bronze(landed, f"{tmp_path}/bronze", "2024-01-05")
    jobs.write_bronze(landed, f"{tmp_path}/bronze", "2024-01-05")
    back = jobs.read_bronze(spark, f"{tmp_path}/bronze")
    assert back.columns == BRONZE_JOBS.fieldNames() + ["date"]
    assert back.count() == 4
    got = {r["id"]: (r["title"], r["company"], r["category"], str(r["date"]))
           for r in back.filter("date = date '2024-01-05'").collect()}
    assert got == {"7": ("Dev", "A", None, "2024-01-05"), "8": (None, None, "IT", "2024-01-05")}


def test_missing_bronze_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        jobs.read_bronze(spark, str(tmp_path))


def test_sql_with_parameters(spark):
    df = tables.run_query(spark, "select id from range(10) where id >= :low", {"low": 8})
    assert sorted(r["id"] for r in df.collect()) == [8, 9]


def test_blank_first_lines_are_no_header(spark, tmp_path):
    put(f"{tmp_path}/a.csv", "\n  \nquestion,topic\nWhat?,tech\n")
    assert [r["question"] for r in questions.read_question_csvs(spark, str(tmp_path)).collect()] == [
        "What?"]


def test_question_folder_of_every_kind(spark, tmp_path):
    put(f"{tmp_path}/a.csv", "Frage,topic\nWhat?,tech\n")
    put(f"{tmp_path}/dl.txt", "1. Padding\nheading\n")
    put(f"{tmp_path}/ml.txt", "S.No\tQuestions\n1\tRMSE\n")
    put(f"{tmp_path}/p.html", "<ul><li>Why?</li></ul>")
    put(f"{tmp_path}/behavioral.txt", "1. Weakness\n")
    read = lambda **k: sorted((r["question"], r["topic"]) for r in
                              questions.read_question_folder(spark, str(tmp_path), **k).collect())
    lists = [("Padding", "technical"), ("RMSE", "technical"), ("Why?", "technical")]
    with pytest.warns(UserWarning, match="a.csv"):
        assert read() == lists
    assert read(candidates=["frage"]) == sorted([*lists, ("What?", "tech")])
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        questions.read_question_folder(spark, str(tmp_path / "none"))


def test_latest_snapshot_opens_the_newest_files_alone(spark, tmp_path):
    put(f"{tmp_path}/raw_20250101_000000.jsonl", '{"question": "old"}\n')
    put(f"{tmp_path}/raw_20250102_000000.jsonl", '{"question": "new"}\n')
    got = questions.read_latest_snapshot(spark, str(tmp_path))
    assert [r["question"] for r in got.collect()] == ["new"]
    assert [f.rsplit("/", 1)[1] for f in got.inputFiles()] == ["raw_20250102_000000.jsonl"]
    put(f"{tmp_path}/x/raw.jsonl", '{"question": "?"}\n')
    with pytest.raises(FileNotFoundError):
        questions.read_latest_snapshot(spark, f"{tmp_path}/x")
