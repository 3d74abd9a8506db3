"""Row shapes of the tables that move between steps.

Fixed values: the column and field names are those of the files that other tools read
and write.
"""

ALTERNATIVES_IN = "array<struct<letra:string,texto:string>>"
ALTERNATIVES = "array<struct<letter:string,text:string>>"

# One element of a page extraction, and one of an answer-key extraction.
QUESTIONS_IN = f"array<struct<numero:bigint,enunciado:string,alternativas:{ALTERNATIVES_IN}>>"
ANSWERS_IN = "array<struct<numero:bigint,resposta:string>>"

# A finished dataset row. The metadata keys vary by series, hence VARIANT.
QUESTION = (
    "id string, exam_source string, question_number bigint, statement string, "
    f"alternatives {ALTERNATIVES}, correct_answer string, nullified boolean"
)
EXAM_QUESTION = f"{QUESTION}, metadata variant"
EXAM_QUESTION_COLUMNS = [
    "id",
    "exam_source",
    "question_number",
    "statement",
    "alternatives",
    "correct_answer",
    "nullified",
    "metadata",
]

MANIFEST_JSON = "map<string,struct<prova_url:string,gabarito_url:string>>"

# The page table: one row per successfully extracted page.
PAGE_KEYS = ["exam", "doc_kind", "page"]
PAGE_TABLE = "exam string, doc_kind string, page int, payload string"

# The same with the version of the table that brought the row.
ARRIVED_PAGE = f"{PAGE_TABLE}, arrived bigint"

# Parts of a question that arrived together, or an answer to one: what a question is stitched from.
PIECES = "array<struct<page:int,pos:int,enunciado:string>>"
PARTIAL = (
    f"exam string, numero bigint, pieces {PIECES}, alternativas {ALTERNATIVES_IN}, page int, pos int, resposta string"
)

# A finished question with the number of the build that made it, and the builds of an exam.
BUILT_QUESTION = f"{QUESTION}, build bigint"
BUILT_EXAM = "exam string, build bigint"
