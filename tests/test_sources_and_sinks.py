import csv
import json

import pytest
from pyspark.sql import functions as F

from quizloom.operators import ordering, pairing
from quizloom.operators.payloads import base64_text, request_table
from quizloom.schemas import EXAM_QUESTION_COLUMNS
from quizloom.sinks.export import CSV_READ, export, export_per_exam, tabular
from quizloom.sources import files

ROW = {
    "id": "vale-041",
    "exam_source": "vale",
    "question_number": 1,
    "statement": "Qual rio banha a cidade?",
    "alternatives": [("A", "o Tejo"), ("B", "o Douro")],
    "correct_answer": "A",
    "nullified": False,
    "metadata": "{}",
}
TYPED = (
    "id string, exam_source string, question_number bigint, statement string, "
    "alternatives array<struct<letter:string,text:string>>, correct_answer string, "
    "nullified boolean, metadata string"
)


def rows(spark, *changes):
    frame = spark.createDataFrame([tuple((ROW | c).values()) for c in changes], TYPED)
    return frame.withColumn("metadata", F.parse_json("metadata"))


def lines(path, pattern="part-*"):
    parts = sorted(p for p in path.rglob(pattern) if not p.name.startswith("."))
    return [line for p in parts for line in p.read_text(encoding="utf-8").splitlines()]


def test_pairs(spark, tmp_path):
    for name in ["b-prova", "b-gabarito", "a-prova", "a-gabarito", "lone-prova", "key-gabarito", "c-PROVA"]:
        (tmp_path / f"{name}.pdf").write_bytes(b"x" * 10)
    (tmp_path / "b-prova.txt").write_text("no document")
    documents = pairing.documents_by_base(files.document_listing(spark, str(tmp_path)))
    pairs = pairing.pairs(documents).orderBy("exam_path").collect()
    assert [p.exam_name for p in pairs] == ["a", "b"]
    assert pairs[0].exam_path.endswith("/a-prova.pdf") and pairs[0].key_path.endswith("/a-gabarito.pdf")
    assert [r.exam_name for r in pairing.unpaired_exams(documents).collect()] == ["lone"]


def test_pairs_with_other_suffixes(spark, tmp_path):
    assert pairing.pairs(pairing.documents_by_base(files.document_listing(spark, str(tmp_path)))).collect() == []
    for name in ["oab-26-exam", "oab-26-answers", "x-a", "x-b-a"]:
        (tmp_path / f"{name}.pdf").write_bytes(b"x")
    listing = files.document_listing(spark, str(tmp_path))
    assert [r.exam_name for r in pairing.pairs(pairing.documents_by_base(listing, "-exam", "-answers")).collect()] == ["oab-26"]
    # One file can be the exam of one pair and the key of another.
    found = pairing.pairs(pairing.documents_by_base(listing, "-a", "-b-a")).collect()
    assert [r.exam_name for r in found] == ["x"]


def test_listing_leaves_the_bytes_unread(spark, tmp_path):
    (tmp_path / "a-prova.pdf").write_bytes(b"x" * 10)
    listing = files.document_listing(spark, str(tmp_path))
    plan = listing._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema:")[1]


def test_page_payloads(spark, tmp_path):
    for exam, kind, page in [("oab-26", "prova", 1), ("oab-26", "prova", 12), ("a b+c", "gabarito", 100)]:
        folder = tmp_path / exam / kind
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"page-{page:02d}.json").write_text('{\n"questoes": []\n}')
        (folder / "notes.json").write_text("{}")
    found = files.page_payloads(spark, str(tmp_path)).collect()
    assert {(r.exam, r.doc_kind, r.page) for r in found} == {
        ("oab-26", "prova", 1),
        ("oab-26", "prova", 12),
        ("a b+c", "gabarito", 100),
    }
    assert {r.payload for r in found} == {'{\n"questoes": []\n}'}


def test_manifest(spark, tmp_path):
    entries = {"26": {"prova_url": "p", "gabarito_url": "g"}, "27": {"prova_url": "q"}}
    (tmp_path / "m.json").write_text(json.dumps(entries, indent=2))
    found = files.manifest(spark, str(tmp_path / "m.json")).collect()
    assert sorted(tuple(r) for r in found) == [(26, "p", "g"), (27, "q", None)]


def test_page_files_with_other_names(spark, tmp_path):
    names = ["e/prova/page-x.json", "page-01.json", "e/other/page-1.json", "e/prova/page-7.json"]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("{}")
    found = {r.path.split(tmp_path.name)[-1].strip("/"): r.reason for r in files.page_files(spark, str(tmp_path)).collect()}
    misnamed = "not <exam>/<kind>/page-NN.json"
    assert found["e/prova/page-x.json"] == misnamed and found["page-01.json"] is not None
    assert found["e/other/page-1.json"] == "unknown kind" and found["e/prova/page-7.json"] is None
    assert [r.page for r in files.page_payloads(spark, str(tmp_path)).collect()] == [7]


@pytest.mark.parametrize("text", ["{broken", "[]", '{"x":{"prova_url":"p"}}', ""])
def test_broken_manifests_stop_the_job(spark, tmp_path, text):
    (tmp_path / "m.json").write_text(text or " ")
    with pytest.raises(Exception):
        files.manifest(spark, str(tmp_path / "m.json")).collect()


def test_page_images_as_requests(spark, tmp_path):
    image = b"\x89PNG\r\n\x1a\n" + bytes(range(256)) * 3
    (tmp_path / "page-01.png").write_bytes(image)
    pages = files.page_images(spark, str(tmp_path)).select(
        F.lit("e").alias("exam"), F.lit("prova").alias("doc_kind"), F.lit(1).alias("page"), "content"
    )
    (row,) = request_table(pages, {"prova": "read"}).collect()
    import base64

    assert row.data == base64.b64encode(image).decode()
    assert (row.prompt, row.mime_type) == ("read", "image/png")
    text = spark.sql("SELECT cast('quatro mares' AS binary) AS b").select(base64_text(F.col("b")))
    assert text.first()[0] == base64.b64encode(b"quatro mares").decode()


def test_tabular(spark):
    frame = tabular(rows(spark, {"correct_answer": None, "statement": "é"}))
    assert frame.columns == EXAM_QUESTION_COLUMNS
    (row,) = frame.collect()
    assert json.loads(row.alternatives) == [{"letter": "A", "text": "o Tejo"}, {"letter": "B", "text": "o Douro"}]
    assert (row.correct_answer, row.metadata) == (None, "{}")


def test_jsonl(spark, tmp_path):
    data = rows(
        spark,
        {"id": "t-003", "question_number": 3, "statement": 'aspas "x", é ã ç ñ ü\nfim'},
        {"id": "t-001", "correct_answer": None, "nullified": True, "metadata": '{"area":"ETHICS","edition":25}'},
        {"id": "t-002", "question_number": 2, "alternatives": []},
    )
    path = export(data, str(tmp_path / "out"))
    text = lines(tmp_path / "out.jsonl")
    found = [json.loads(line) for line in text]
    assert [f["question_number"] for f in found] == [1, 2, 3]
    assert all(list(f) == EXAM_QUESTION_COLUMNS for f in found)
    assert found[0]["correct_answer"] is None and '"correct_answer":null' in text[0]
    assert found[0]["metadata"] == {"area": "ETHICS", "edition": 25}
    assert found[2]["statement"] == 'aspas "x", é ã ç ñ ü\nfim' and "é ã ç ñ ü" in text[2]
    assert found[1]["alternatives"] == [] and found[1]["metadata"] == {}
    again = files.question_dataset(spark, path)
    pack = F.to_json("metadata").alias("metadata")
    assert sorted(again.withColumn("metadata", pack).collect()) == sorted(
        data.withColumn("metadata", pack).collect()
    )


def test_dataset_scan(spark, tmp_path):
    good = json.dumps(ROW | {"alternatives": [], "metadata": {"k": [1]}})
    (tmp_path / "d.jsonl").write_text(f"{good}\n\n  \n{good}\n")
    assert files.question_dataset(spark, str(tmp_path / "d.jsonl")).count() == 2
    (tmp_path / "bad.jsonl").write_text(f"{good}\n{{broken\n")
    with pytest.raises(Exception, match="bad line in dataset"):
        files.question_dataset(spark, str(tmp_path / "bad.jsonl")).collect()
    few = {k: v for k, v in ROW.items() if k not in ("alternatives", "metadata", "nullified", "correct_answer")}
    (tmp_path / "few.jsonl").write_text(json.dumps(few | {"question_number": "7"}) + "\n")
    (row,) = files.question_dataset(spark, str(tmp_path / "few.jsonl")).collect()
    assert (row.question_number, row.alternatives, row.correct_answer, row.nullified) == (7, [], None, False)


@pytest.mark.parametrize(
    "change",
    [
        {"id": None},
        {"statement": 5},
        {"question_number": "x"},
        {"alternatives": None},
        {"alternatives": [{"letter": "A"}]},
        {"correct_answer": 1},
        {"nullified": "maybe"},
        {"metadata": [1]},
    ],
)
def test_dataset_rows_of_other_types_stop_the_read(spark, tmp_path, change):
    line = json.dumps(ROW | {"alternatives": [], "metadata": {}} | change)
    (tmp_path / "d.jsonl").write_text(line + "\n")
    with pytest.raises(Exception, match="bad line in dataset"):
        files.question_dataset(spark, str(tmp_path / "d.jsonl")).collect()


def test_csv(spark, tmp_path):
    statement = 'vírgula, "aspas"\nlinha \\ é ã'
    data = rows(
        spark,
        {"id": "t-002", "question_number": 2, "statement": statement},
        {"id": "t-001", "correct_answer": None, "nullified": True},
    )
    path = export(data, str(tmp_path / "out"), "csv")
    parts = sorted((tmp_path / "out.csv").glob("part-*"))
    found = [r for p in parts for r in csv.DictReader(p.open(encoding="utf-8", newline=""))]
    assert [r["id"] for r in found] == ["t-001", "t-002"]
    assert list(found[0]) == EXAM_QUESTION_COLUMNS
    assert found[1]["statement"] == statement
    assert [r["nullified"] for r in found] == ["True", "False"]
    assert [r["correct_answer"] for r in found] == ["", "A"]
    assert json.loads(found[1]["alternatives"])[1] == {"letter": "B", "text": "o Douro"}
    back = spark.read.options(**CSV_READ).csv(path).orderBy("id").collect()
    assert back[1].statement == statement


def test_empty_csv_has_a_header(spark, tmp_path):
    export(rows(spark, {}).where("false"), str(tmp_path / "out"), "csv")
    assert lines(tmp_path / "out.csv") == [",".join(EXAM_QUESTION_COLUMNS)]


def test_formats(spark, tmp_path):
    data = rows(spark, {})
    assert export(data, str(tmp_path / "x"), "both") == str(tmp_path / "x.jsonl")
    assert (tmp_path / "x.csv").exists()
    for write in (export, export_per_exam):
        with pytest.raises(ValueError, match="unknown format"):
            write(data, str(tmp_path / "y"), "xml")
    assert not (tmp_path / "y.csv").exists()


def test_per_exam(spark, tmp_path):
    changes = [
        {"id": f"{e}-{n:03d}", "exam_source": e, "question_number": n}
        for e, count in [("oab-1", 90), ("oab-2", 10), ("oab 3/x", 2)]
        for n in range(count, 0, -1)
    ]
    base = export_per_exam(rows(spark, *changes).repartition(5), str(tmp_path), "both")
    assert base == f"{tmp_path}/per-edition/jsonl"
    folder = tmp_path / "per-edition" / "jsonl"
    assert len(list(folder.glob("source=*"))) == 3
    found = [json.loads(line) for line in lines(folder / "source=oab-1")]
    assert [f["question_number"] for f in found] == list(range(1, 91))
    assert {f["exam_source"] for f in found} == {"oab-1"}
    assert list(found[0]) == EXAM_QUESTION_COLUMNS
    assert len(list((tmp_path / "per-edition" / "csv").glob("source=*"))) == 3


def test_orders(spark):
    data = spark.createDataFrame(
        [("a", 1, 2), ("b", 1, 1), ("c", 2, None), ("d", 1, None), ("e", 2, 1)],
        "id string, question_number int, edition int",
    )

    def ids(order):
        numbered = ordering.with_position(data.repartition(3), ordering.dataset_order(order))
        found = sorted((r.position, r.id) for r in numbered.collect())
        assert [p for p, _ in found] == [1, 2, 3, 4, 5]
        return "".join(i for _, i in found)

    assert ids("number_first") == "dbace"
    assert ids("edition_first") == "dcbea"
    with pytest.raises(ValueError, match="unknown order"):
        ordering.dataset_order("other")


@pytest.fixture
def uncoalesced(spark):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, before)


def test_copies_are_spread_over_tasks(spark, tmp_path, uncoalesced):
    """Most rows are copies of one; no file gets all of them, and none is lost."""
    one = rows(spark, {"id": "t-005", "question_number": 5})
    data = one.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(3000)))).drop("n").repartition(6)
    others = rows(spark, *[{"id": f"t-{n:03d}", "question_number": n} for n in range(100)])
    data = data.unionByName(others)
    export(data, str(tmp_path / "out"))
    counts = [len(p.read_text().splitlines()) for p in sorted((tmp_path / "out.jsonl").glob("part-*"))]
    assert sum(counts) == 3100 and max(counts) < 1500
    export_per_exam(data, str(tmp_path))
    folder = tmp_path / "per-edition" / "jsonl" / "source=vale"
    counts = [len(p.read_text().splitlines()) for p in folder.glob("part-*")]
    assert sum(counts) == 3100 and max(counts) < 1500
    numbered = ordering.with_position(
        data.select("id", "question_number"), [F.col("question_number"), F.col("id")]
    )
    assert sorted(r.position for r in numbered.collect()) == list(range(1, 3101))


def test_formats_share_one_sort(spark, tmp_path, monkeypatch):
    """Both formats are written from rows that were sorted and moved once; nothing is staged or kept."""
    from quizloom.sinks import export as sink

    seen, write = [], sink._write

    def watched(rows, path, fmt, partition):
        seen.append(rows._jdf.queryExecution().optimizedPlan().toString().split("InMemoryRelation")[0])
        write(rows, path, fmt, partition)

    monkeypatch.setattr(sink, "_write", watched)
    rows = spark.range(50).select(
        F.format_string("q-%03d", "id").alias("id"),
        F.lit("e").alias("exam_source"),
        (F.lit(50) - F.col("id")).alias("question_number"),
        F.lit("text").alias("statement"),
        F.array(F.struct(F.lit("A").alias("letter"), F.lit("x").alias("text"))).alias("alternatives"),
        F.lit("A").alias("correct_answer"),
        F.lit(False).alias("nullified"),
        F.parse_json(F.lit("{}")).alias("metadata"),
    )
    sink.export(rows, str(tmp_path / "all"), "both")
    assert len(seen) == 2 and not any("Sort" in plan or "Relation" in plan for plan in seen)
    assert spark.read.text(str(tmp_path / "all.jsonl")).count() == 50
    assert spark.read.option("header", True).csv(str(tmp_path / "all.csv")).count() == 50
    assert spark._jsparkSession.sharedState().cacheManager().isEmpty()
