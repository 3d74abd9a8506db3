import pytest

from quizloom.functions import payload
from quizloom.operators import assemble

GOOD = [
    ('{"questoes":[{"numero":1,"enunciado":"é"}]}', [(1, "é", [])]),
    ('{"questoes":[{"numero":"12","enunciado":"s","alternativas":[]}]}', [(12, "s", [])]),
    ('{"questoes":[{"numero":" 7 ","enunciado":""}]}', [(7, "", [])]),
    ('{"questoes":[{"numero":3.0,"enunciado":"s","extra":[1]}]}', [(3, "s", [])]),
    (
        '{"questoes":[{"numero":1,"enunciado":"a\\nb","alternativas":[{"letra":"A","texto":"x"}]},'
        '{"numero":2,"enunciado":"c"}]}',
        [(1, "a\nb", [("A", "x")]), (2, "c", [])],
    ),
    ("{}", []),
    (' {"questoes":[]}', []),
    ('{"questoes":[]}\n\t ', []),
    ('{"questoes":[{"numero":true,"enunciado":"s"}]}', [(1, "s", [])]),
    ('{"questoes":[{"numero":false,"enunciado":"true"}]}', [(0, "true", [])]),
    ('{"questoes":[{"numero":"1_000","enunciado":"12"}]}', [(1000, "12", [])]),
    ('{"questoes":[{"numero":"1_000.0","enunciado":"[1]"}]}', [(1000, "[1]", [])]),
    ('{"questoes":[{"numero":3000000000,"enunciado":"{}"}]}', [(3000000000, "{}", [])]),
    ('{"questoes":[{"numero":1e2,"enunciado":"false"}]}', [(100, "false", [])]),
    ('{"questoes":[{"numero":"007","enunciado":"-"}]}', [(7, "-", [])]),
    ('{"questoes":[{"numero":1,"numero":2,"enunciado":"a","enunciado":"b"}]}', [(2, "b", [])]),
    ('{"questoes":[],"questoes":[{"numero":4,"enunciado":"d"}]}', [(4, "d", [])]),
]
BAD = [
    ('{"questoes":[]} x', "not JSON"),
    ('{"questoes":[]}{"questoes":[]}', "not JSON"),
    ('{"questoes":[]},{"questoes":[]}', "not JSON"),
    ('{"questoes":[]}]', "not JSON"),
    ('{"questoes":[]}} }', "not JSON"),
    ('{"questoes":[{"numero":"7.","enunciado":"s"}]}', "bad item in questoes"),
    ('{"questoes":[{"numero":"_1","enunciado":"s"}]}', "bad item in questoes"),
    ('{"questoes":[{"numero":"1__0","enunciado":"s"}]}', "bad item in questoes"),
    ('{"questoes":[{"numero":"true","enunciado":"s"}]}', "bad item in questoes"),
    ('{"questoes":[{"numero":99999999999999999999,"enunciado":"s"}]}', "bad item in questoes"),
    ('{"questoes":[{"numero":1,"enunciado":true}]}', "bad item in questoes"),
    ('{"questoes":[{"numero":1,"enunciado":["a"]}]}', "bad item in questoes"),
    ("{broken", "not JSON"),
    ("", "not JSON"),
    (None, "missing payload"),
    ("null", "not an object"),
    ("[1]", "not an object"),
    ('"text"', "not an object"),
    ('{"questoes":null}', "questoes is not a list"),
    ('{"questoes":{}}', "questoes is not a list"),
    ('{"questoes":[{"enunciado":"s"}]}', "bad item in questoes"),
    ('{"questoes":[{"numero":1}]}', "bad item in questoes"),
    ('{"questoes":[{"numero":1.5,"enunciado":"s"}]}', "bad item in questoes"),
    ('{"questoes":[{"numero":"x","enunciado":"s"}]}', "bad item in questoes"),
    ('{"questoes":[{"numero":1,"enunciado":5}]}', "bad item in questoes"),
    ('{"questoes":[{"numero":1,"enunciado":null}]}', "bad item in questoes"),
    ('{"questoes":[null]}', "bad item in questoes"),
    ('{"questoes":[3]}', "bad item in questoes"),
    ('{"questoes":[{"numero":1,"enunciado":"s","alternativas":null}]}', "bad item in questoes"),
    ('{"questoes":[{"numero":1,"enunciado":"s","alternativas":[{"letra":"A"}]}]}', "bad item in questoes"),
    ('{"questoes":[{"numero":1,"enunciado":"s","alternativas":[{"letra":1,"texto":"x"}]}]}', "bad item in questoes"),
    ('{"questoes":[{"numero":1,"enunciado":"s"},{"numero":2}]}', "bad item in questoes"),
]


def pages(spark, payloads):
    rows = [("e", "prova", n, text) for n, text in enumerate(payloads)]
    return spark.createDataFrame(rows, "exam string, doc_kind string, page int, payload string")


def test_good_payloads(spark):
    decoded = payload.decode_questions(pages(spark, [p for p, _ in GOOD]))
    rows = assemble.explode_questions(payload.good_pages(decoded)).orderBy("page", "pos").collect()
    found = {}
    for r in rows:
        item = (r.numero, r.enunciado, [tuple(a) for a in r.alternativas])
        found.setdefault(r.page, []).append(item)
    assert found == {n: questions for n, (_, questions) in enumerate(GOOD) if questions}
    assert payload.quarantine(decoded).collect() == []


def test_bad_payloads(spark):
    decoded = payload.decode_questions(pages(spark, [p for p, _ in BAD]))
    found = payload.quarantine(decoded).orderBy("page").collect()
    assert [(r.payload, r.error) for r in found] == BAD
    assert assemble.explode_questions(payload.good_pages(decoded)).collect() == []


@pytest.mark.parametrize(
    "text, answers, error",
    [
        ('{"respostas":[{"numero":1,"resposta":"A"},{"numero":"2","resposta":"X"}]}', [(1, "A"), (2, "X")], None),
        ("{}", [], None),
        ('{"respostas":[{"numero":1,"resposta":null}]}', None, "bad item in respostas"),
        ('{"respostas":7}', None, "respostas is not a list"),
    ],
)
def test_answers(spark, text, answers, error):
    (row,) = payload.decode_answers(pages(spark, [text])).collect()
    found = None if row.respostas is None else [tuple(a) for a in row.respostas]
    assert (found, row.error) == (answers, error)
