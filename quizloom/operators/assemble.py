"""Stitch split questions, collect answer keys and join the two."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizloom.functions.names import question_id
from quizloom.functions.rows import rows_of_list
from quizloom.operators.ordering import with_position
from quizloom.staging import staged

KEYS = ["exam", "numero"]

# A question with more parts than this is stitched in pieces of this many parts.
HOT_PARTS = 10_000


def explode_questions(pages: DataFrame) -> DataFrame:
    """One row per question on a page; pages without questions give none."""
    return rows_of_list(pages, ["exam", "page"], "questoes").select(
        "exam",
        "page",
        "pos",
        "item.numero",
        "item.enunciado",
        F.coalesce("item.alternativas", F.array()).alias("alternativas"),
    )


def explode_answers(pages: DataFrame) -> DataFrame:
    rows = rows_of_list(pages, ["exam", "page"], "respostas")
    return rows.select("exam", "page", "pos", "item.numero", "item.resposta")


def hot_questions(parts: DataFrame, min_parts: int = HOT_PARTS) -> DataFrame:
    """Keys that hold too many parts for one group: a count over the key columns."""
    counts = parts.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") > min_parts).select(*KEYS)


def _stitch(parts: DataFrame, keys: list[str], n_parts, place=None) -> DataFrame:
    """Join texts in (page, pos) order; of the longest option lists keep the last.

    ``place`` tells parts of equal page and position apart.
    """
    at = ["page", "pos", (F.lit(0).cast("long") if place is None else place).alias("place")]
    piece = F.struct(*at, "enunciado")
    in_order = F.transform(F.array_sort(F.collect_list(piece)), lambda p: p["enunciado"])
    return parts.groupBy(*keys).agg(
        F.array_join(in_order, " ").alias("enunciado"),
        F.max_by("alternativas", F.struct(F.size("alternativas"), *at)).alias("alternativas"),
        F.max(F.struct(*at)).alias("last"),
        F.sum(n_parts).alias("parts"),
    )


def question_pieces(parts: DataFrame, parts_per_piece: int = HOT_PARTS) -> DataFrame:
    """Stitch within runs of a question's parts: one row per question and run.

    Parts are numbered in the order of all (question, page, pos) by a range sort, which no
    question or page is too large for; a run has ``parts_per_piece`` of them at most. In
    ``piece`` order the rows spell out the whole question. This is also the form in which
    to keep a question too large for one cell.
    """
    order = [F.col(name) for name in (*KEYS, "page", "pos")]
    numbered = with_position(parts, order, "_nth")
    piece = F.floor((F.col("_nth") - 1) / parts_per_piece)
    return _stitch(numbered.withColumn("piece", piece), [*KEYS, "piece"], F.lit(1), F.col("_nth"))


def merge_split_questions(
    parts: DataFrame, min_hot_parts: int = HOT_PARTS, parts_per_piece: int = HOT_PARTS
) -> DataFrame:
    """One row per question: ``exam, numero, enunciado, alternativas, parts``.

    Texts are joined by a space in page order. The longest option list wins, the
    later one on a tie. Hot questions are stitched in two steps, so that no task
    sorts all their parts.
    """
    hot = staged(hot_questions(parts, min_hot_parts), "hot-questions")
    if hot.isEmpty():
        return _stitch(parts, KEYS, F.lit(1)).drop("last")
    usual = _stitch(parts.join(hot, KEYS, "left_anti"), KEYS, F.lit(1))
    pieces = question_pieces(parts.join(hot, KEYS, "left_semi"), parts_per_piece)
    joined = _stitch(
        pieces.select(
            *KEYS,
            F.col("last.page").alias("page"),
            F.col("last.pos").alias("pos"),
            F.col("last.place").alias("_nth"),
            "enunciado",
            "alternativas",
            F.col("parts").alias("n"),
        ),
        KEYS,
        F.col("n"),
        F.col("_nth"),
    )
    return usual.unionByName(joined).drop("last")


def split_count(questions: DataFrame) -> DataFrame:
    """Parts beyond the first, per exam."""
    return questions.groupBy("exam").agg(F.sum(F.col("parts") - 1).alias("splits"))


def collect_answers(answers: DataFrame) -> DataFrame:
    """First answer per question in page, then list order."""
    return answers.groupBy(*KEYS).agg(
        F.min_by("resposta", F.struct("page", "pos")).alias("resposta")
    )


def join_answers(
    questions: DataFrame, answers: DataFrame, nullified: DataFrame | None = None
) -> DataFrame:
    """Dataset rows without metadata.

    A question without an answer, or named in ``nullified`` (``exam, numero``), has
    no correct answer and is nullified. Answers without a question are dropped.
    ``answers`` holds one row per key.
    """
    joined = questions.join(answers, KEYS, "left")
    if nullified is None:
        flagged = F.lit(False)
    else:
        flags = nullified.select(*KEYS).distinct().withColumn("flagged", F.lit(True))
        joined = joined.join(flags, KEYS, "left")
        flagged = F.coalesce("flagged", F.lit(False))
    correct = F.when(~flagged, F.col("resposta"))
    return joined.select(
        question_id(F.col("exam"), F.col("numero")).alias("id"),
        F.col("exam").alias("exam_source"),
        F.col("numero").alias("question_number"),
        F.col("enunciado").alias("statement"),
        output_alternatives().alias("alternatives"),
        correct.alias("correct_answer"),
        correct.isNull().alias("nullified"),
    )


def output_alternatives(column: str = "alternativas"):
    return F.transform(
        column, lambda a: F.struct(a["letra"].alias("letter"), a["texto"].alias("text"))
    )


def with_base_metadata(rows: DataFrame, **values) -> DataFrame:
    """The same metadata values on each row."""
    return rows.withColumns({name: F.lit(value) for name, value in values.items()})
