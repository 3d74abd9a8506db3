import json
import random

import pytest
from pyspark.sql import functions as F

from quizloom.operators import hashed, manifest, report, resume, usage
from quizloom.plans import builds
from quizloom.schemas import PAGE_TABLE
from quizloom.sources.files import question_dataset, raw_blocks
from quizloom.staging import staging_root
from quizloom.streaming import ingest
from quizloom.versions import publish

OUTPUTS = [("a", "jsonl"), ("b", "csv"), ("c", "jsonl"), ("c", "csv"), ("c", "csv")]


@pytest.mark.parametrize(
    "fmt, force, pending",
    [("jsonl", False, "bd"), ("csv", False, "ad"), ("both", False, "abd"), ("both", True, "abcd")],
)
def test_pending(spark, fmt, force, pending):
    pairs = spark.createDataFrame([(e,) for e in "abcd"], "exam string")
    outputs = spark.createDataFrame(OUTPUTS, "exam string, fmt string")
    found = resume.pending_exams(pairs, outputs, fmt, force).collect()
    assert "".join(sorted(r.exam for r in found)) == pending


def test_unknown_format(spark):
    outputs = spark.createDataFrame(OUTPUTS, "exam string, fmt string")
    with pytest.raises(ValueError, match="unknown format"):
        resume.finished_exams(outputs, "xml")


def page(exam, number, text, failed=False, kind="prova"):
    return (exam, kind, number, text, failed)


def fresh(spark, *pages):
    return spark.createDataFrame(list(pages), f"{PAGE_TABLE}, failed boolean")


def keyed(rows):
    return {(r.exam, r.doc_kind, r.page, r.payload) for r in rows.collect()}


def test_page_table(spark, tmp_path):
    path, aside = str(tmp_path / "pages"), str(tmp_path / "aside")
    assert resume.read_page_table(spark, path).collect() == []
    one, two = question_page((1, "x")), question_page((2, "y"))
    first = fresh(
        spark,
        page("a", 1, one, failed=None),
        page("a", 2, two, failed=True),
        page("a", 4, "{broken"),
        page("a", 5, '{"questoes":[]} x'),
        page("a", None, one),
        page("a", 6, one, kind="other"),
    )
    for _ in range(2):
        resume.append_new_pages(first, path, aside, 1)
    bad = {(r.page, r.reason) for r in spark.read.parquet(aside).collect()}
    assert bad == {(4, "not JSON"), (5, "not JSON"), (None, "missing key"), (6, "unknown kind")}
    assert spark.read.parquet(aside).count() == 4
    later = fresh(spark, page("a", 1, two), page("a", 2, two), page("a", 2, two), page("a", 4, one))
    resume.append_new_pages(later, path, aside, 2)
    table = resume.read_page_table(spark, path)
    assert keyed(table) == {("a", "prova", 1, one), ("a", "prova", 2, two), ("a", "prova", 4, one)}
    assert table.count() == 3
    pages = spark.createDataFrame(
        [("a", "prova", 1), ("a", "gabarito", 1), ("a", "prova", 3)],
        "exam string, doc_kind string, page int",
    )
    cached = resume.with_cached_payload(pages, table)
    assert {tuple(r) for r in cached.collect()} == {
        ("a", "prova", 1, one, True),
        ("a", "gabarito", 1, None, False),
        ("a", "prova", 3, None, False),
    }
    assert "Aggregate" not in cached._jdf.queryExecution().executedPlan().toString()


def parts_read(rows):
    """(part, bucket) of the files behind ``rows``."""
    return {tuple(int(x.split("=")[1]) for x in f.split("/")[-3:-1]) for f in rows.inputFiles()}


def test_only_buckets_at_hand_are_read(spark, tmp_path):
    path = str(tmp_path / "pages")
    resume.append_new_pages(fresh(spark, *[page(f"e{n}", 1, question_page((1, "x"))) for n in range(40)]), path)
    assert parts_read(resume.read_page_table(spark, path, [3, 5])) == {(1, 3), (1, 5)}
    assert resume.read_page_table(spark, path, [3, 5]).where("bucket NOT IN (3, 5)").isEmpty()


# As many as a run takes; with 50 the bounds hold as well.
APPENDS = 15


def test_page_table_grows(spark, tmp_path):
    path, keys = str(tmp_path / "pages"), set()
    for n in range(APPENDS):
        new = {(f"e{n * 7 % 60}", n), (f"e{n}", 100 + n), ("hot", n)}
        keys |= new
        # Each append brings known keys too.
        known = sorted(keys)[:3]
        rows = [page(e, p, question_page((1, "x"))) for e, p in sorted(new) + known]
        resume.append_new_pages(fresh(spark, *rows).coalesce(1), path, rows_per_bucket=4, most_parts=3)
        if n % 7 == 0 or n == APPENDS - 1:
            found = [(r.exam, r.page) for r in resume.read_page_table(spark, path).collect()]
            assert sorted(found) == sorted(keys)
    _, state = resume.page_state(spark, path)
    assert hashed.bucket_count(state) == -(-len(keys) // 4) > hashed.BASE
    assert all(len(b["parts"]) <= 4 for b in state["buckets"].values())
    assert hashed.total_rows(state) == len(keys)
    files = resume.read_page_table(spark, path).inputFiles()
    assert len(files) <= 5 * hashed.bucket_count(state)
    rows = resume.read_page_table(spark, path)
    assert rows.where(F.col("bucket") != hashed.bucket_of(state, F.col("exam"))).isEmpty()
    resume.drop_old_pages(spark, path)
    assert sorted((r.exam, r.page) for r in resume.read_page_table(spark, path).collect()) == sorted(keys)
    assert sorted(f.removeprefix("file://") for f in files) == sorted(map(str, (tmp_path / "pages").glob("rows/*/*/*.parquet")))


def test_filters_name_all_that_is_known(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "pages")
    resume.append_new_pages(fresh(spark, *[page("a", n, question_page((1, "x"))) for n in range(300)]), path)
    _, state = resume.page_state(spark, path)

    def held(*pages):
        rows = spark.createDataFrame([("a", "prova", n) for n in pages], "exam string, doc_kind string, page int")
        rows = rows.withColumn("bucket", hashed.bucket_of(state, F.col("exam")))
        return hashed.maybe_known(spark, state, path, rows, ["exam", "doc_kind", "page"])

    assert all(held(n) for n in range(0, 300, 60)) and held(5000, 17)
    # New keys read none of the table's; some would if the filter were a guess.
    assert held(*range(1000, 1040)) == []
    # A filter that knows everything costs a read and changes nothing.
    monkeypatch.setattr(hashed, "FILTER_BITS", 1)
    monkeypatch.setattr(hashed, "SLOT", 8)
    small = str(tmp_path / "small")
    for _ in range(2):
        resume.append_new_pages(fresh(spark, *[page("a", n, question_page((1, "x"))) for n in range(300)]), small)
        assert resume.read_page_table(spark, small).count() == 300


def test_a_step_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "pages")
    resume.append_new_pages(fresh(spark, page("a", 1, question_page((1, "x")))), path)

    def die(*_):
        raise RuntimeError("lost")

    more = fresh(spark, page("a", 2, question_page((2, "y"))), page("b", 1, question_page((1, "z"))))
    with monkeypatch.context() as patched:
        patched.setattr(resume, "publish", die)
        with pytest.raises(RuntimeError):
            resume.append_new_pages(more, path)
    assert resume.read_page_table(spark, path).count() == 1
    resume.append_new_pages(more, path)
    assert resume.read_page_table(spark, path).count() == 3
    with pytest.raises(FileExistsError):
        publish(spark, path, 1, {})


def question_page(*questions):
    return json.dumps({"questoes": [{"numero": n, "enunciado": t} for n, t in questions]})


def answer_page(*answers):
    return json.dumps({"respostas": [{"numero": n, "resposta": a} for n, a in answers]})


def test_ingest(spark, tmp_path):
    drops, pages, questions, checkpoint = (
        str(tmp_path / name) for name in ("drops", "pages", "questions", "checkpoint")
    )

    def step(*arrived):
        if arrived:
            fresh(spark, *arrived).coalesce(1).write.mode("append").json(drops)
        ingest.ingest_new_pages(spark, drops, pages, checkpoint)
        ingest.refresh_questions(spark, pages, questions)
        current = ingest.current_questions(spark, questions).drop("alternatives")
        built = builds.page_questions(resume.read_page_table(spark, pages)).select(current.columns)
        assert sorted(map(str, current.collect())) == sorted(map(str, built.collect()))
        rows = current.collect()
        return {r.id: (r.statement, r.correct_answer) for r in rows}, resume.read_page_table(spark, pages).count()

    first = step(
        page("a", 1, question_page((1, "start"))),
        page("a", 3, "", failed=True),
        page("b", 1, question_page((1, "only"))),
        page("b", 2, answer_page((1, "C")), kind="gabarito"),
    )
    assert first == ({"a-001": ("start", None), "b-001": ("only", "C")}, 3)
    version, _ = ingest.question_state(spark, questions)
    assert step() == first and ingest.question_state(spark, questions)[0] == version
    later = step(
        page("a", 3, question_page((2, "new"))),
        page("a", 2, question_page((1, "end"))),
        page("a", 9, answer_page((1, "B"), (1, "A")), kind="gabarito"),
    )
    assert later == ({"a-001": ("start end", "B"), "a-002": ("new", None), "b-001": ("only", "C")}, 6)
    # The late pages wrote their own exam only, from its own partials.
    build, state = ingest.question_state(spark, questions)
    written = spark.read.parquet(f"{questions}/questions/rows/part={build}")
    assert {r.exam_source for r in written.collect()} == {"a"}
    exam = spark.createDataFrame([("a",)], "exam string")
    bucket = exam.select(hashed.bucket_of(state["partials"], F.col("exam"))).first()[0]
    assert {b for _, b in parts_read(ingest.touched_partials(spark, questions, state, exam))} == {bucket}
    ingest.drop_superseded(spark, questions)
    assert step() == later
    _, state = ingest.question_state(spark, questions)
    assert hashed.total_rows(state["questions"]) == 3


def test_partials_merge_to_the_full_build(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "MOST_PIECES", 2)
    path, questions, random_ = str(tmp_path / "pages"), str(tmp_path / "questions"), random.Random(6)

    def options(n):
        return [{"letra": "ABCDE"[i], "texto": f"o{random_.randrange(9)}"} for i in range(n)]

    arriving = []
    for exam in range(6):
        for number in range(1, 9):
            found = [
                {"numero": random_.randrange(4), "enunciado": f"p{number}.{i}", "alternativas": options(random_.randrange(4))}
                for i in range(random_.randrange(4))
            ]
            arriving.append(page(f"e{exam}", number, json.dumps({"questoes": found})))
            arriving.append(page(f"e{exam}", number, answer_page((random_.randrange(4), "ABCDE"[number % 5])), kind="gabarito"))
    random_.shuffle(arriving)
    for start in range(0, len(arriving), 32):
        resume.append_new_pages(fresh(spark, *arriving[start : start + 32]), path)
        ingest.refresh_questions(spark, path, questions)
        current = ingest.current_questions(spark, questions)
        built = builds.page_questions(resume.read_page_table(spark, path)).select(current.columns)
        assert sorted(map(str, current.collect())) == sorted(map(str, built.collect()))
        if start == 32:
            ingest.arrange_questions(spark, questions, rows_per_bucket=5, most_parts=1)
    _, state = ingest.question_state(spark, questions)
    assert hashed.bucket_count(state["partials"]) > hashed.BASE


def test_bad_lines_are_set_aside(spark, tmp_path):
    drops, pages, checkpoint = (str(tmp_path / n) for n in ("drops", "pages", "checkpoint"))
    good = {"exam": "a", "doc_kind": "prova", "page": 1, "payload": question_page((1, "x"))}
    lines = [json.dumps(good), "{cut", json.dumps(good | {"page": "3x"}), json.dumps(good | {"exam": None})]
    (tmp_path / "drops").mkdir()
    (tmp_path / "drops" / "one.json").write_text("\n".join(lines) + "\n")
    for _ in range(2):
        ingest.ingest_new_pages(spark, drops, pages, checkpoint)
    assert resume.read_page_table(spark, pages).count() == 1
    bad = spark.read.parquet(f"{pages}-quarantine").collect()
    assert sorted(r.reason for r in bad) == ["malformed line", "malformed line", "missing key"]
    assert {r._corrupt_record for r in bad} == {lines[1], lines[2], None}


USAGE = "exam string, model string, input_tokens long, output_tokens long, total_tokens long"


def test_usage(spark):
    data = spark.createDataFrame(
        [("a", "m", 10, 1, 11), ("a", "m", None, None, None), ("b", "m", 5, 2, 7)], USAGE
    )
    found = {r.exam: (r.input_tokens, r.output_tokens, r.total_tokens) for r in usage.usage_by_exam(data).collect()}
    assert found == {"a": (10, 1, 11), "b": (5, 2, 7), None: (15, 3, 18)}


@pytest.mark.parametrize(
    "model, cost", [("x-pro-1", 2.617274), ("X-Flash", 0.6543185), ("other", 2.617274)]
)
def test_cost(spark, model, cost):
    data = spark.createDataFrame([("a", model, 1_234_567, 12_345, 1_246_912)], USAGE)
    found = {r.exam: r.cost_usd for r in usage.cost_by_exam(data).collect()}
    assert found == {"a": pytest.approx(cost, abs=1e-12), None: pytest.approx(cost, abs=1e-12)}


def test_failed_pages(spark):
    pages = fresh(
        spark,
        page("a", 2, "", True, "gabarito"),
        page("a", 10, "", True),
        page("a", 9, "", True),
        page("a", 1, "x"),
    )
    found = report.failed_pages(pages).orderBy("exam", "kind_rank", "page").collect()
    assert [r.label for r in found] == ["9", "10", "gab-2"]


def test_summary(spark):
    schema = "edition int, branch string"
    data = spark.createDataFrame([(3, "text"), (3, "page"), (None, "page"), (7, "page")], schema)
    assert tuple(report.dataset_summary(data).first()) == (4, 1, 3, 2, 3, 7)
    assert tuple(report.dataset_summary(data.where("false")).first()) == (0, 0, 0, 0, 0, 0)


def test_run_status(spark):
    pairs = spark.createDataFrame([(e,) for e in "abcd"], "exam string")
    done = spark.createDataFrame([("b",), ("b",), ("z",)], "exam string")
    errors = spark.createDataFrame([("c", "bad"), ("b", "old")], "exam string, error string")
    statuses = report.run_status(pairs, done, errors)
    assert sorted(tuple(r) for r in statuses.collect()) == [
        ("a", "successful", None),
        ("b", "skipped", None),
        ("c", "failed", "bad"),
        ("d", "successful", None),
    ]
    counts = {tuple(r) for r in report.status_counts(statuses).collect()}
    assert counts == {("successful", 2), ("skipped", 1), ("failed", 1)}


def test_upsert(spark):
    base = spark.createDataFrame(
        [(35, "p35", "k35"), (36, "p36", "k36"), (37, "p37", "k37")],
        "edition int, prova_url string, gabarito_url string",
    )
    updates = spark.createDataFrame(
        [(35, 0, "n35", 6000), (36, 0, "n36", 4999), (38, 0, "n38", 5000), (37, 1, "b", 9000), (37, 0, "a", 9000)],
        "edition int, ord int, gabarito_url string, length long",
    )
    found = sorted(map(str, (tuple(r) for r in manifest.upsert_keys(base, updates).collect())))
    assert found == sorted(
        map(str, [(35, "p35", "n35"), (36, "p36", "k36"), (37, "p37", "b"), (38, None, "n38")])
    )


def test_completeness(spark):
    records = spark.createDataFrame(
        [(1, "p", "k"), (2, None, "k"), (3, "", None)],
        "edition int, prova_url string, gabarito_url string",
    )
    checked = manifest.completeness(records)
    assert [(r.status, r.missing) for r in checked.orderBy("edition").collect()] == [
        ("OK", []),
        ("PARTIAL", ["prova"]),
        ("PARTIAL", ["prova", "gabarito"]),
    ]
    assert {tuple(r) for r in manifest.status_totals(checked).collect()} == {("OK", 1), ("PARTIAL", 2)}


def page_table(spark, series_names):
    rows = []
    for exam in series_names:
        rows += [
            (exam, "prova", 1, question_page((1, "um"), (2, "dois"))),
            (exam, "prova", 2, question_page((2, "fim"), (3, "três"))),
            (exam, "prova", 3, "{broken"),
            (exam, "gabarito", 1, json.dumps({"respostas": [{"numero": 1, "resposta": "A"}, {"numero": 2, "resposta": "B"}]})),
        ]
    return spark.createDataFrame(rows, PAGE_TABLE)


def staged_tables(spark):
    import os

    return sorted(os.listdir(staging_root(spark)))


def test_build_all(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    block = "Questão 2\n\nAREA CIVIL\n\nTexto.\n\nOPTIONS\n\nA) a\n\nB:CORRECT) b\n"
    for stem in ("2012-06", "2012-06a"):
        (raw / f"{stem}.txt").write_text(block, encoding="utf-8")
    blocks = raw_blocks(spark, str(raw))
    before = staged_tables(spark)
    dated, numbered = builds.build_all(
        spark,
        page_table(spark, ["enam-20242r"]),
        page_table(spark, ["oab-26", "oab-27"]),
        blocks,
        str(tmp_path / "out"),
        "both",
    )
    rows = question_dataset(spark, dated).orderBy("question_number")
    found = rows.select("id", "statement", "correct_answer", "nullified", F.to_json("metadata")).collect()
    metadata = '{"edition":"20242r","reapplication":true,"semester":2,"source_format":"pdf","year":2024}'
    assert [tuple(r) for r in found] == [
        ("enam-20242r-001", "um", "A", False, metadata),
        ("enam-20242r-002", "dois fim", "B", False, metadata),
        ("enam-20242r-003", "três", None, True, metadata),
    ]
    parts = sorted((tmp_path / "out" / "oab" / "oab-exams.jsonl").glob("part-*"))
    written = [json.loads(line) for p in parts for line in p.read_text().splitlines()]
    # Ordered by number, then edition; equal ids of two files are both kept.
    assert [(w["question_number"], w["id"]) for w in written] == [
        (1, "oab-26-001"),
        (1, "oab-27-001"),
        (2, "oab-6-002"),
        (2, "oab-6-002"),
        (2, "oab-26-002"),
        (2, "oab-27-002"),
        (3, "oab-26-003"),
        (3, "oab-27-003"),
    ]
    assert written[2]["metadata"] == {"area": "CIVIL", "edition": 6, "source_format": "raw_text", "year": 2012}
    assert written[0]["metadata"] == {"edition": 26, "source_format": "pdf"}
    folders = {p.name for p in (tmp_path / "out" / "oab" / "per-edition" / "csv").iterdir() if p.is_dir()}
    assert folders == {"source=oab-26", "source=oab-27", "source=oab-6"}
    assert not [p for p in staged_tables(spark) if p not in before]
    united = builds.combined(question_dataset(spark, dated), question_dataset(spark, numbered))
    assert united.count() == 11


def test_ranges_label_page_rows_only(spark):
    ranges = spark.createDataFrame(
        [(26, 0, 1, 2, "ETHICS"), (6, 0, 1, 9, "TAXES")],
        "edition int, ord int, start_q int, end_q int, label string",
    )
    blocks = spark.createDataFrame(
        [("2012-06", 0, "Questão 2\n\nAREA CIVIL\n\nT.\n\nOPTIONS\n\nA) a\n")],
        "stem string, block_no int, block string",
    )
    rows = builds.numbered_series_rows(blocks, builds.page_questions(page_table(spark, ["oab-26"])), ranges)
    found = {(r.id, r.area, r.branch) for r in rows.collect()}
    assert found == {
        ("oab-6-002", "CIVIL", "text"),
        ("oab-26-001", "ETHICS", "page"),
        ("oab-26-002", "ETHICS", "page"),
        ("oab-26-003", None, "page"),
    }
