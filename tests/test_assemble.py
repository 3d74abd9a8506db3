import random

import pytest

from quizloom.operators import assemble
from quizloom.schemas import ALTERNATIVES_IN

PAGES = (
    "exam string, page int, questoes array<struct<numero:int,enunciado:string,"
    f"alternativas:{ALTERNATIVES_IN}>>"
)
KEY_PAGES = "exam string, page int, respostas array<struct<numero:int,resposta:string>>"


def question(number, text, letters=""):
    return (number, text, [(letter, f"option {letter}") for letter in letters])


def merged(spark, pages, **options):
    frame = spark.createDataFrame([("e", n, qs) for n, qs in pages], PAGES)
    rows = assemble.merge_split_questions(assemble.explode_questions(frame), **options)
    found = rows.orderBy("numero").collect()
    splits = sum(r.parts - 1 for r in found)
    return [
        (r.numero, r.enunciado, "".join(a.letra for a in r.alternativas)) for r in found
    ], splits


CASES = {
    "one page": ([(1, [question(1, "a", "AB"), question(2, "b", "AB")])], [(1, "a", "AB"), (2, "b", "AB")], 0),
    "several pages": ([(1, [question(1, "a", "A")]), (2, [question(2, "b", "A")])], [(1, "a", "A"), (2, "b", "A")], 0),
    "empty pages": ([(1, []), (2, [question(1, "a", "A")]), (3, [])], [(1, "a", "A")], 0),
    "no questions": ([(1, []), (2, None)], [], 0),
    "out of order": ([(2, [question(2, "b")]), (1, [question(1, "a")])], [(1, "a", ""), (2, "b", "")], 0),
    "split": (
        [(1, [question(1, "x", "A"), question(2, "start")]), (2, [question(2, "end", "AB"), question(3, "z", "A")])],
        [(1, "x", "A"), (2, "start end", "AB"), (3, "z", "A")],
        1,
    ),
    "tie": ([(1, [question(1, "a", "AB")]), (2, [question(1, "b", "CD")])], [(1, "a b", "CD")], 1),
    "later shorter": ([(1, [question(1, "a", "ABC")]), (2, [question(1, "b", "A")])], [(1, "a b", "ABC")], 1),
    "three parts": (
        [(3, [question(1, "c")]), (1, [question(1, "a", "AB")]), (2, [question(1, "b ", "A")])],
        [(1, "a b  c", "AB")],
        2,
    ),
    "same page twice": ([(1, [question(1, "x"), question(1, "y")])], [(1, "x y", "")], 1),
    "equal texts": ([(1, [question(1, "x")]), (2, [question(1, "x")])], [(1, "x x", "")], 1),
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("min_hot_parts", [assemble.HOT_PARTS, 0])
def test_merge(spark, case, min_hot_parts):
    """With a threshold of 0 each question takes the two-step way of hot ones."""
    pages, expected, splits = CASES[case]
    assert merged(spark, pages, min_hot_parts=min_hot_parts) == (expected, splits)


def brute_force(parts):
    """Sequential fold over the parts in page order."""
    result = {}
    for exam, number, page, pos, text, options in sorted(parts, key=lambda p: (p[2], p[3])):
        if (exam, number) not in result:
            result[exam, number] = (text, options)
        else:
            before, kept = result[exam, number]
            result[exam, number] = (
                f"{before} {text}",
                options if len(options) >= len(kept) else kept,
            )
    return result


@pytest.mark.parametrize("min_hot_parts", [assemble.HOT_PARTS, 100, 0])
def test_skewed_parts_equal_brute_force(spark, min_hot_parts):
    """A third of all parts belong to one question; rows arrive in random order."""
    rng = random.Random(3)
    parts = []
    for i in range(3000):
        key = ("hot", 1) if i % 3 == 0 else (f"e{rng.randrange(5)}", rng.randrange(200))
        options = [(chr(65 + k), f"{i}-{k}") for k in range(rng.randrange(5))]
        parts.append((*key, rng.randrange(20_000), i, f"t{i}", options))
    rng.shuffle(parts)
    schema = (
        "exam string, numero int, page int, pos int, enunciado string, "
        f"alternativas {ALTERNATIVES_IN}"
    )
    frame = spark.createDataFrame(parts, schema).repartition(7)
    found = assemble.merge_split_questions(frame, min_hot_parts=min_hot_parts).collect()
    got = {
        (r.exam, r.numero): (r.enunciado, [tuple(a) for a in r.alternativas]) for r in found
    }
    assert len(found) == len(got)
    assert got == brute_force(parts)


@pytest.mark.parametrize("pages", [lambda i: 1, lambda i: i, lambda i: i * 1000, lambda i: i % 3])
def test_pieces_are_bounded_and_spell_out_the_question(spark, pages):
    """All parts on one page, dense and sparse pages; positions tell parts of a page apart."""
    parts = [("e", 1, pages(i), i, f"p{i}", []) for i in range(2500)] + [("f", 1, 1, 0, "x", [])]
    schema = (
        "exam string, numero int, page int, pos int, enunciado string, "
        f"alternativas {ALTERNATIVES_IN}"
    )
    frame = spark.createDataFrame(parts, schema).repartition(5)
    pieces = assemble.question_pieces(frame, parts_per_piece=100).orderBy("exam", "piece").collect()
    assert max(r.parts for r in pieces) <= 100 and len(pieces) <= 28
    text = " ".join(p[4] for p in sorted(parts[:-1], key=lambda p: (p[2], p[3])))
    assert " ".join(r.enunciado for r in pieces if r.exam == "e") == text
    merged = assemble.merge_split_questions(frame, min_hot_parts=50, parts_per_piece=100).collect()
    assert {r.exam: r.enunciado for r in merged} == {"e": text, "f": "x"}


def test_no_hot_question_leaves_no_hot_branch(spark):
    pages = spark.createDataFrame(
        [("e", n, [question(n % 7, f"t{n}", "AB")]) for n in range(50)], PAGES
    )
    rows = assemble.merge_split_questions(assemble.explode_questions(pages))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and "piece" not in plan and "Join" not in plan


def test_split_count(spark):
    pages = spark.createDataFrame(
        [("a", 1, [question(1, "x")]), ("a", 2, [question(1, "y"), question(1, "z")]), ("b", 1, [question(1, "x")])],
        PAGES,
    )
    questions = assemble.merge_split_questions(assemble.explode_questions(pages))
    assert {tuple(r) for r in assemble.split_count(questions).collect()} == {("a", 2), ("b", 0)}


@pytest.mark.parametrize(
    "pages, expected",
    [
        ([(1, [(1, "A"), (2, "B"), (3, "C")])], {1: "A", 2: "B", 3: "C"}),
        ([(1, [(1, "A"), (2, "B")]), (2, [(3, "C"), (4, "D")])], {1: "A", 2: "B", 3: "C", 4: "D"}),
        ([(1, [])], {}),
        ([(2, [(1, "B")]), (1, [(1, "C")])], {1: "C"}),
        ([(1, [(1, "E"), (1, "A")])], {1: "E"}),
    ],
)
def test_first_answer_counts(spark, pages, expected):
    frame = spark.createDataFrame([("e", n, answers) for n, answers in pages], KEY_PAGES)
    found = assemble.collect_answers(assemble.explode_answers(frame)).collect()
    assert {r.numero: r.resposta for r in found} == expected


def answered(spark, numbers, answers, nullified=None, exam="serra-4"):
    questions = spark.createDataFrame(
        [(exam, n, f"q{n}", [("A", "first"), ("B", "second")]) for n in numbers],
        f"exam string, numero int, enunciado string, alternativas {ALTERNATIVES_IN}",
    )
    key = spark.createDataFrame(
        [(exam, n, a) for n, a in answers.items()], "exam string, numero int, resposta string"
    )
    flags = None
    if nullified is not None:
        flags = spark.createDataFrame([(exam, n) for n in nullified], "exam string, numero int")
    return assemble.join_answers(questions, key, flags).orderBy("question_number").collect()


def test_answers_and_nullification(spark):
    rows = answered(spark, [1, 2, 3, 4], {1: "A", 3: "C", 4: "", 9: "E"}, nullified=[3, 3])
    assert [(r.question_number, r.correct_answer, r.nullified) for r in rows] == [
        (1, "A", False),
        (2, None, True),
        (3, None, True),
        (4, "", False),
    ]


def test_output_shape(spark):
    rows = answered(spark, [1, 1234], {1: "A"})
    assert [r.id for r in rows] == ["serra-4-001", "serra-4-1234"]
    assert {r.exam_source for r in rows} == {"serra-4"}
    assert [a.asDict() for a in rows[0].alternatives] == [
        {"letter": "A", "text": "first"},
        {"letter": "B", "text": "second"},
    ]


def test_base_metadata(spark):
    rows = spark.createDataFrame([(1,), (2,)], "n int")
    found = assemble.with_base_metadata(rows, edition=4, year=1999).collect()
    assert [tuple(r) for r in found] == [(1, 4, 1999), (2, 4, 1999)]
