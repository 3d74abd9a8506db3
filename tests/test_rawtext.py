import pytest
from pyspark.sql import functions as F

from quizloom.functions import text
from quizloom.operators import rawtext
from quizloom.sources.files import raw_blocks

TWO = """\
Questão 1

AREA ETHICS

Ana e Rui foram ao mesmo
advogado.

O que fazer?

OPTIONS

A:CORRECT) optar, com prudência,
por um deles.

B) ficar com ambos.

C) nada.

D) outra coisa.


Questão 2

AREA CONSTITUTIONAL

Assinale a certa.

OPTIONS

A) um.

B) dois.

C:CORRECT) três.

D) quatro.
"""


def block(number="1", null="", area="AREA ETHICS\n\n", statement="Texto.", options="A:CORRECT) a.\n\nB) b."):
    return f"Questão {number}{null}\n\n{area}{statement}\n\nOPTIONS\n\n{options}\n"


def parse(spark, value, stem="2010-01"):
    texts = spark.createDataFrame([(stem, value)], "stem string, value string")
    parsed = rawtext.parse_blocks(rawtext.blocks_of_texts(texts))
    return rawtext.good_questions(parsed).orderBy("question_number").collect(), [
        r.reason for r in rawtext.rejected_blocks(parsed).orderBy("block_no").collect()
    ]


def test_normal_questions(spark):
    (first, second), _ = parse(spark, TWO)
    assert (first.question_number, first.correct_answer, first.nullified) == (1, "A", False)
    assert (first.id, first.exam_source, first.area) == ("oab-1-001", "oab-1", "ETHICS")
    assert (first.edition, first.year, first.source_format) == (1, 2010, "raw_text")
    assert first.statement == "Ana e Rui foram ao mesmo advogado. O que fazer?"
    assert [a.letter for a in first.alternatives] == ["A", "B", "C", "D"]
    assert first.alternatives[0].text == "optar, com prudência, por um deles."
    assert (second.id, second.correct_answer, second.area) == ("oab-1-002", "C", "CONSTITUTIONAL")


def test_null_header(spark):
    for null in (" NULL", "\nNULL"):
        (row,), _ = parse(spark, block(null=null))
        assert (row.nullified, row.correct_answer, row.area) == (True, None, "ETHICS")


@pytest.mark.parametrize(
    "line, area",
    [
        ("AREA\n\n", "NI"),
        ("AREA \t\n\n", "NI"),
        ("AREA PHILOSHOPY\n\n", "PHILOSOPHY"),
        ("AREA ASTRONOMY\n\n", "NI"),
        ("AREA ethics\n\n", "NI"),
        ("AREA  TAXES  \n\n", "TAXES"),
        ("", "NI"),
        ("lost text\nAREA CIVIL\n\n", "CIVIL"),
    ],
)
def test_area(spark, line, area):
    (row,), _ = parse(spark, block(area=line))
    assert row.area == area
    assert row.statement == "Texto."


@pytest.mark.parametrize(
    "stem, edition, year", [("2018-25", 25, 2018), ("2012-06a", 6, 2012), ("2012-20aa", 20, 2012)]
)
def test_file_name(spark, stem, edition, year):
    (row,), _ = parse(spark, block(), stem)
    assert (row.edition, row.year, row.exam_source) == (edition, year, f"oab-{edition}")


@pytest.mark.parametrize(
    "value, reasons",
    [
        ("intro\n" + block(), ["bad header"]),
        ("Questão 3\n\nAREA CIVIL\n\nsem opções\n", ["no options"]),
        (block(statement=" "), ["empty statement"]),
        (block(number="3 extra"), ["bad header"]),
        ("Questão 3\n\nTexto.\n\nOPTIONS\n\nA) a\n\nAREA CIVIL\n", ["empty statement"]),
        (block(statement="Antes.\nQuestão 5 diz isso"), ["no options", "bad header"]),
        ("", ["empty block"]),
    ],
)
def test_rejects(spark, value, reasons):
    rows, found = parse(spark, value)
    assert found == reasons
    assert len(rows) == (1 if value.startswith("intro") else 0)


def test_bad_file_name(spark):
    assert parse(spark, block(), "notes") == ([], ["bad file name"])


@pytest.mark.parametrize(
    "options, letters, texts, correct",
    [
        ("A:CORRECT) x\nB:CORRECT) y", "AB", ["x", "y"], "B"),
        ("A) x\nB) y", "AB", ["x", "y"], None),
        ("C)\nD) x\nE) y", "CE", ["D) x", "y"], None),
        ("C)\nD)\nE) y", "CE", ["D)", "y"], None),
        ("A)\n\n\nB:CORRECT) y", "A", ["B:CORRECT) y"], None),
        ("before\nA) x\n\n  more  \n\ny\nF) z", "A", ["x more y F) z"], None),
        ("A) x\nOPTIONS\nB) y", "A", ["x"], None),
        ("A) $1 \\ x\nB)  y \nz", "AB", ["$1 \\ x", "y z"], None),
        ("E) only", "E", ["only"], None),
        ("A) x\n\nB)", "AB", ["x", ""], None),
    ],
)
def test_alternatives(spark, options, letters, texts, correct):
    (row,), _ = parse(spark, block(options=options))
    assert "".join(a.letter for a in row.alternatives) == letters
    assert [a.text for a in row.alternatives] == texts
    assert row.correct_answer == correct


def test_line_ends(spark):
    for end in ("\r\n", "\r"):
        assert parse(spark, TWO.replace("\n", end)) == parse(spark, TWO)


def test_very_long_alternative(spark):
    body = "\n".join(f"linha {i}" for i in range(20_000))
    (row,), _ = parse(spark, block(options=f"A) {body}\nB) b"))
    assert row.alternatives[0].text == body.replace("\n", " ")
    assert row.alternatives[1].text == "b"


def test_one_line(spark):
    rows = spark.createDataFrame(
        [("  a  b \n\n\t c ",), ("\n",), ("x",), ("a \nb\x1c",)], "t string"
    )
    found = [r[0] for r in rows.select(text.one_line(F.col("t"))).collect()]
    assert found == ["a  b c", "", "x", "a b"]


def some_texts():
    """Preambles, blocks of all kinds, headers over two lines; each line end."""
    for n, end in enumerate(["\n", "\r\n", "\r", "\n"]):
        value = ["", "preâmbulo\n", "\n\n", "intro\nQuestão\n\n"][n]
        for i in range(1, 40):
            extra = "\nQuestão relativa à ética\n\nQuestão de ordem\nQuestão" if i % 5 == 0 else ""
            value += block(number=str(i), statement=f"Texto {i}.{extra}") + "\n" * (i % 3)
            if i % 9 == 0:
                value += f"Questão\n\n {i + 100}\n\nAREA CIVIL\n\nT.\n\nOPTIONS\n\nA) a\n"
            if i % 11 == 0:
                value += f"Questão {i + 200}\n\nsem opções\n"
        yield f"201{n}-0{n + 1}", value.replace("\n", end)


@pytest.mark.parametrize("size", ["128m", "3000b", "777b", "64b"])
def test_files_give_the_blocks_of_their_texts(spark, tmp_path, size):
    """Small splits cut blocks and headers anywhere; good and rejected rows stay the same."""
    texts = list(some_texts())
    for stem, value in texts:
        (tmp_path / f"{stem}.txt").write_text(value, encoding="utf-8", newline="")

    def found(blocks, order):
        parsed = rawtext.parse_blocks(blocks)
        good = rawtext.good_questions(parsed).orderBy("stem", *order)
        bad = rawtext.rejected_blocks(parsed).orderBy("stem", *order)
        columns = ["stem", "id", "statement", "alternatives", "correct_answer"]
        return [tuple(r) for r in good.select(*columns).collect()] + [
            tuple(r) for r in bad.select("stem", "block", "reason").collect()
        ]

    whole = spark.createDataFrame(texts, "stem string, value string")
    want = found(rawtext.blocks_of_texts(whole), ["block_no"])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        got = found(raw_blocks(spark, str(tmp_path)), ["split_start", "block_no"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == want
    assert {r[-1] for r in want} >= {"bad header", "empty block", "no options"}


def test_empty_folder(spark, tmp_path):
    assert raw_blocks(spark, str(tmp_path)).collect() == []


def test_files_are_parsed_once(spark, tmp_path):
    """Good and rejected blocks come from one parse, and only pieces at the borders of splits are shuffled again."""
    from quizloom.plans.catalog import QUERIES

    rows = spark.range(40).select(
        F.col("id").alias("doc_id"), F.concat_ws("\n", F.lit("one"), F.lit(""), F.col("id").cast("string")).alias("text")
    )
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["raw_text_files"](spark, str(tmp_path))
    assert "regexp_replace" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.where("reason IS NULL").count() == 80 and found.where("reason IS NOT NULL").count() == 42
