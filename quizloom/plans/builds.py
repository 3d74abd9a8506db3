"""Dataset builds: from page payloads and raw text to exported datasets."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom.fixed_values import DATED_SERIES, EXAM_KIND, KEY_KIND, NUMBERED_SERIES
from quizloom.functions.payload import decode_answers, decode_questions, good_pages
from quizloom.operators import assemble, enrich, ordering, rawtext, report, resume
from quizloom.schemas import ANSWERS_IN, EXAM_QUESTION_COLUMNS, QUESTIONS_IN
from quizloom.sinks.export import export_per_exam, formats, write_per_exam, write_sorted
from quizloom.staging import scratch, staged, staged_with_row

NUMBERED_KEYS = ["area", "edition", "year", "source_format"]
DATED_KEYS = ["edition", "year", "semester", "reapplication", "source_format", "subject"]
CORE_COLUMNS = EXAM_QUESTION_COLUMNS[:-1]


def decoded_pages(page_table: DataFrame) -> DataFrame:
    """``exam, doc_kind, page, questoes, respostas, error`` of every page: the lists of its kind, or why it is bad.

    Payloads are dear to parse; whoever needs more than one figure of them stages this.
    """
    exam_pages = decode_questions(page_table.where(F.col("doc_kind") == EXAM_KIND))
    key_pages = decode_answers(page_table.where(F.col("doc_kind") == KEY_KIND))
    columns = ["exam", "doc_kind", "page", "questoes", "respostas", "error"]
    return (
        exam_pages.withColumn("respostas", F.lit(None).cast(ANSWERS_IN)).select(*columns)
        .unionByName(key_pages.withColumn("questoes", F.lit(None).cast(QUESTIONS_IN)).select(*columns))
    )


def page_questions(page_table: DataFrame, nullified: DataFrame | None = None) -> DataFrame:
    """Questions of the exams in a page table, with answers, without metadata.

    The decoded parts are written once: looking for hot questions then reads only
    the key columns, and no payload is parsed twice. Bad pages count as empty.
    """
    exam_pages = page_table.where(F.col("doc_kind") == EXAM_KIND)
    key_pages = page_table.where(F.col("doc_kind") == KEY_KIND)
    parts = staged(
        assemble.explode_questions(good_pages(decode_questions(exam_pages))), "question-parts"
    )
    answers = assemble.explode_answers(good_pages(decode_answers(key_pages)))
    return assembled_questions(parts, answers, nullified)


def assembled_questions(parts: DataFrame, answers: DataFrame, nullified: DataFrame | None = None) -> DataFrame:
    """Questions from the parts of pages and the answers of keys."""
    return assemble.join_answers(
        assemble.merge_split_questions(parts), assemble.collect_answers(answers), nullified
    )


def page_outcomes(page_table: DataFrame) -> DataFrame:
    """``exam, doc_kind, page, failed, found``: did the page decode, and into how much."""
    return outcomes_of(decoded_pages(page_table))


def outcomes_of(decoded: DataFrame) -> DataFrame:
    """``page_outcomes`` of decoded pages."""
    return decoded.select(
        "exam",
        "doc_kind",
        "page",
        F.col("error").isNotNull().alias("failed"),
        F.coalesce(F.size("questoes"), F.size("respostas"), F.lit(0)).alias("found"),
    )


def resumed_questions(
    page_table: DataFrame, cached: DataFrame, force: bool = False
) -> DataFrame:
    """Questions of finished exams as stored, and of the others built from their pages.

    The stored rows have no metadata: it is added after this union, to both alike.
    """
    if force:
        return page_questions(page_table)
    finished_exams = cached.select(F.col("exam_source").alias("exam")).distinct()
    pending = page_table.join(finished_exams, "exam", "left_anti")
    return cached.select(*CORE_COLUMNS).unionByName(page_questions(pending))


def numbered_series_rows(
    blocks: DataFrame | None,
    page_rows: DataFrame | None,
    ranges: DataFrame | None = None,
    series: str = NUMBERED_SERIES,
) -> DataFrame:
    """Union of the raw-text and page branches with typed metadata columns.

    Only page rows get their edition and area from the exam name and the ranges;
    raw text carries its own. Equal ids from two branches are both kept.
    """
    columns = [*CORE_COLUMNS, *NUMBERED_KEYS, "branch", "stem"]
    branches = []
    if blocks is not None:
        parsed = rawtext.good_questions(rawtext.parse_blocks(blocks, series))
        branches.append(parsed.withColumn("branch", F.lit("text")).select(*columns))
    if page_rows is not None:
        null = {"area": "string", "edition": "int", "year": "int", "source_format": "string"}
        rows = page_rows.select(
            *CORE_COLUMNS,
            *[F.lit(None).cast(kind).alias(name) for name, kind in null.items()],
            F.lit("page").alias("branch"),
            F.col("exam_source").alias("stem"),
        )
        rows = enrich.fill_numbered_edition(rows, "exam_source", series)
        if ranges is not None:
            rows = enrich.label_by_range(rows, ranges)
        branches.append(rows.select(*columns))
    result = branches[0]
    for branch in branches[1:]:
        result = result.unionByName(branch)
    return result


def dated_series_rows(
    page_rows: DataFrame, ranges: DataFrame | None = None, series: str = DATED_SERIES
) -> DataFrame:
    """Page rows of the series with year-and-semester editions."""
    rows = enrich.set_dated_edition(page_rows, "exam_source", series)
    if ranges is None:
        rows = rows.withColumn("subject", F.lit(None).cast("string"))
    else:
        rows = enrich.label_by_range(rows, ranges, label="subject")
    return rows.select(*CORE_COLUMNS, *DATED_KEYS)


def finished(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Dataset rows with packed metadata. ``edition`` stays alongside for ordering."""
    packed = enrich.pack_metadata(rows.withColumn("sort_edition", F.col("edition")), keys)
    return packed.select(*EXAM_QUESTION_COLUMNS, F.col("sort_edition").alias("edition"))


def combined(*datasets: DataFrame) -> DataFrame:
    """One dataset of several series. Their editions differ in type, so it has none."""
    result = datasets[0].select(*EXAM_QUESTION_COLUMNS)
    for dataset in datasets[1:]:
        result = result.unionByName(dataset.select(*EXAM_QUESTION_COLUMNS))
    return result


def write_dataset(
    rows: DataFrame, folder: str, name: str, fmt: str = "jsonl", missing_edition=0
) -> str:
    """Export the dataset and its per-exam folders; returns the main path."""
    formats(fmt)
    with scratch(rows.sparkSession):
        table = staged_with_row(rows, name)
        order = ordering.dataset_order("number_first", missing_edition)
        main = write_sorted(table, f"{folder.rstrip('/')}/{name}", fmt, order)
        write_per_exam(table, folder, fmt)
    return main


def build_all(
    spark: SparkSession,
    dated_pages: DataFrame,
    numbered_pages: DataFrame,
    raw_blocks: DataFrame | None,
    folder: str,
    fmt: str = "jsonl",
) -> tuple[str, str]:
    """Both series as separate outputs, the dated one first. What they staged is deleted."""
    base = folder.rstrip("/")
    with scratch(spark):
        dated = finished(dated_series_rows(page_questions(dated_pages)), DATED_KEYS)
        first = write_dataset(dated, f"{base}/{DATED_SERIES}", f"{DATED_SERIES}-exams", fmt, "")
    with scratch(spark):
        numbered = finished(
            numbered_series_rows(raw_blocks, page_questions(numbered_pages)), NUMBERED_KEYS
        )
        second = write_dataset(
            numbered, f"{base}/{NUMBERED_SERIES}", f"{NUMBERED_SERIES}-exams", fmt
        )
    return first, second


def run_exams(
    pairs: DataFrame,
    page_table: DataFrame,
    outputs: DataFrame,
    folder: str,
    fmt: str = "jsonl",
    force: bool = False,
) -> DataFrame:
    """Build and export the exams that are still to do, one folder each; the status of every exam of ``pairs``.

    ``outputs`` (``exam, fmt``) are the finished ones, which are skipped unless forced. An
    exam without pages or without a readable exam page fails with that error and doesn't
    stop the others. Statuses are those of ``report.run_status``.
    """
    spark = pairs.sparkSession
    formats(fmt)
    exams = pairs.select("exam").distinct()
    pending = staged(resume.pending_exams(exams, outputs, fmt, force), "pending-exams")
    pages = page_table.join(pending, "exam", "left_semi")
    # Every payload is parsed once, for the errors and for the questions.
    decoded = staged(decoded_pages(pages), "decoded-pages")
    readable = outcomes_of(decoded.where(F.col("doc_kind") == EXAM_KIND))
    readable = readable.groupBy("exam").agg(F.count_if(~F.col("failed")).alias("good"))
    error = F.when(F.col("good").isNull(), "no pages").when(F.col("good") == 0, "no readable page")
    judged = staged(pending.join(readable, "exam", "left").select("exam", error.alias("error")), "run-errors")
    failed = judged.where("error IS NOT NULL")
    with scratch(spark):
        good = decoded.drop("error").join(failed, "exam", "left_anti")
        rows = assembled_questions(assemble.explode_questions(good), assemble.explode_answers(good))
        export_per_exam(finished(numbered_series_rows(None, rows), NUMBERED_KEYS), folder, fmt)
    return report.run_status(exams, exams.join(pending, "exam", "left_anti"), failed)
