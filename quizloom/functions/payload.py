"""Decode and check the JSON of one extracted page.

The checks follow the typed model of the payload: required fields, strings that
must be strings, whole numbers that may come as text, nothing after the object. A page
that breaks one is set aside with the reason; it is never partly used.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizloom.fixed_values import EXAM_KIND, KEY_KIND
from quizloom.functions.rows import rows_where
from quizloom.functions.text import strip
from quizloom.schemas import ANSWERS_IN, QUESTIONS_IN


def _field(value: Column, name: str) -> Column:
    return F.try_variant_get(value, f"$.{name}", "variant")


def _string(value: Column) -> Column:
    # Telling a value's type is dear. As text, numbers, booleans, lists and objects begin
    # with one of these characters; whatever begins otherwise was a string.
    def checked(text: Column) -> Column:
        doubtful = text.rlike(r"\A[-+0-9tf\[{]")
        return F.when(~doubtful | (F.schema_of_variant(value) == "STRING"), text)

    return _let(F.try_variant_get(value, "$", "string"), checked)


def _whole_number(value: Column) -> Column:
    """A BIGINT from 7, 7.0, "7", " 7 ", "1_000" or true (1); null from anything else.

    Whole numbers beyond BIGINT count as bad.
    """

    def number(text: Column) -> Column:
        digits = text.rlike(r"\A[+-]?[0-9]+(_[0-9]+)*(\.0+)?\z")
        whole = F.replace(F.substring_index(text, ".", 1), F.lit("_"), F.lit("")).try_cast("bigint")
        is_truth = text.isin("true", "false") & (F.schema_of_variant(value) == "BOOLEAN")
        return F.when(digits, whole).when(is_truth, F.when(text == "true", 1).otherwise(0).cast("bigint"))

    # Lists and objects never look like a number as text.
    return _let(strip(F.try_variant_get(value, "$", "string")), number)


def _list_field(owner: Column, name: str) -> Column:
    """Items of a list that may be absent (empty) but not null or another type."""
    items = F.try_variant_get(owner, f"$.{name}", "array<variant>")
    absent = _field(owner, name).isNull()
    return F.when(absent, F.array().cast("array<variant>")).otherwise(items)


def _question(item: Column) -> Column:
    options = F.transform(
        _list_field(item, "alternativas"),
        lambda a: F.struct(
            _string(_field(a, "letra")).alias("letra"),
            _string(_field(a, "texto")).alias("texto"),
        ),
    )
    return F.struct(
        _whole_number(_field(item, "numero")).alias("numero"),
        _string(_field(item, "enunciado")).alias("enunciado"),
        options.alias("alternativas"),
    )


def _answer(item: Column) -> Column:
    return F.struct(
        _whole_number(_field(item, "numero")).alias("numero"),
        _string(_field(item, "resposta")).alias("resposta"),
    )


def _question_is_bad(q: Column) -> Column:
    return (
        q["numero"].isNull()
        | q["enunciado"].isNull()
        | q["alternativas"].isNull()
        | F.exists(q["alternativas"], lambda a: a["letra"].isNull() | a["texto"].isNull())
    )


def _answer_is_bad(a: Column) -> Column:
    return a["numero"].isNull() | a["resposta"].isNull()


def whole_json(rows: DataFrame, text: Column) -> Column:
    """The value that ``text`` is, as a VARIANT; null if it is not JSON from end to end.

    A parser stops after the first value. Between brackets and before a number that
    depends on the text, whatever follows that value breaks the list of two.
    """
    mark = F.xxhash64(text).cast("string")
    enclosed = F.concat(F.lit("["), text, F.lit(","), mark, F.lit("]"))

    def first(both: Column) -> Column:
        is_whole = (F.try_variant_get(both, "$[1]", "string") == mark) & F.try_variant_get(
            both, "$[2]", "variant"
        ).isNull()
        return F.when(is_whole, F.try_variant_get(both, "$[0]", "variant"))

    # The last of repeated keys counts.
    rows.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return _let(F.try_parse_json(enclosed), first)


def _is_object(text: Column) -> Column:
    """Valid JSON is an object exactly if it opens with a brace."""
    return F.startswith(F.ltrim(text, F.lit(" \t\r\n")), F.lit("{"))


def checked_questions(lines: DataFrame) -> DataFrame:
    """Dataset rows from JSON lines in ``value``; a bad line stops the job with its text."""
    line = F.col("value")

    def row(document: Column) -> Column:
        options = F.transform(
            _list_field(document, "alternatives"),
            lambda a: F.struct(_string(_field(a, "letter")).alias("letter"), _string(_field(a, "text")).alias("text")),
        )
        answer = _field(document, "correct_answer")
        flag = _field(document, "nullified")
        extra = _field(document, "metadata")
        # A JSON null is a VARIANT too.
        null_answer = answer.isNull() | F.is_variant_null(answer)
        values = F.struct(
            _string(_field(document, "id")).alias("id"),
            _string(_field(document, "exam_source")).alias("exam_source"),
            _whole_number(_field(document, "question_number")).alias("question_number"),
            _string(_field(document, "statement")).alias("statement"),
            options.alias("alternatives"),
            _string(answer).alias("correct_answer"),
            F.when(flag.isNull(), False).otherwise(F.try_variant_get(flag, "$", "boolean")).alias("nullified"),
            F.when(extra.isNull(), F.parse_json(F.lit("{}"))).otherwise(extra).alias("metadata"),
        )

        def sound(found: Column) -> Column:
            fields = ("id", "exam_source", "question_number", "statement", "alternatives", "nullified")
            bad = ~_is_object(line) | document.isNull()
            for name in fields:
                bad = bad | found[name].isNull()
            bad = bad | F.exists(found["alternatives"], lambda a: a["letter"].isNull() | a["text"].isNull())
            bad = bad | (~null_answer & found["correct_answer"].isNull())
            bad = bad | ~F.startswith(F.schema_of_variant(found["metadata"]), F.lit("OBJECT"))
            message = F.raise_error(F.concat(F.lit("bad line in dataset: "), F.left(line, F.lit(500))))
            return F.when(F.coalesce(bad, F.lit(True)), message).otherwise(found)

        return _let(values, sound)

    kept = lines.where(F.trim(line) != "")
    checked = _let(whole_json(lines, line), row)
    return kept.select(checked.alias("row")).select("row.*")


def _decoded(pages: DataFrame, name: str, convert, is_bad, item_type: str) -> Column:
    """``struct<name, error>`` of each page, one of them null."""
    payload = F.col("payload")

    def checked(items: Column, document: Column) -> Column:
        error = (
            F.when(payload.isNull(), "missing payload")
            .when(document.isNull(), "not JSON")
            .when(~_is_object(payload), "not an object")
            .when(items.isNull(), f"{name} is not a list")
            .when(F.exists(items, is_bad), f"bad item in {name}")
        )
        return F.struct(F.when(error.isNull(), items).alias(name), error.alias("error"))

    # One expression per page, whose steps are bound by ``_let``: spread over columns,
    # a pushed-down filter would repeat the parsing in each place that refers to it.
    return _let(
        whole_json(pages, payload),
        lambda document: _let(
            F.transform(_list_field(document, name), convert).cast(item_type),
            lambda items: checked(items, document),
        ),
    )


def _decoded_questions(pages: DataFrame) -> Column:
    return _decoded(pages, "questoes", _question, _question_is_bad, QUESTIONS_IN)


def _decoded_answers(pages: DataFrame) -> Column:
    return _decoded(pages, "respostas", _answer, _answer_is_bad, ANSWERS_IN)


def page_error(pages: DataFrame) -> Column:
    """What is wrong with each page by its kind; null if nothing is."""
    return (
        F.when(F.col("doc_kind") == EXAM_KIND, _decoded_questions(pages)["error"])
        .when(F.col("doc_kind") == KEY_KIND, _decoded_answers(pages)["error"])
        .otherwise("unknown kind")
    )


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def decode_questions(pages: DataFrame) -> DataFrame:
    """Add ``questoes`` (null on a bad page) and ``error`` (null on a good one)."""
    return pages.withColumn("_decoded", _decoded_questions(pages)).select(*pages.columns, "_decoded.*")


def decode_answers(pages: DataFrame) -> DataFrame:
    """Add ``respostas`` (null on a bad page) and ``error`` (null on a good one)."""
    return pages.withColumn("_decoded", _decoded_answers(pages)).select(*pages.columns, "_decoded.*")


def good_pages(decoded: DataFrame) -> DataFrame:
    """Decoded pages; a bad one has a null list, which gives no rows when exploded."""
    return decoded.drop("error", "payload")


def quarantine(decoded: DataFrame) -> DataFrame:
    """Pages set aside: key, payload and reason."""
    columns = ["exam", "doc_kind", "page", "payload", "error"]
    return rows_where(decoded, F.col("error").isNotNull(), columns)
