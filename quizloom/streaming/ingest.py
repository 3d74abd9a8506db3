"""Take in new page payloads as they arrive and rebuild the questions of the exams they touch.

The question table keeps, beside the finished questions, the partial stitches they are made
of: pieces of a question that arrived together, in order, and the longest option list with
its place. A late page is decoded once, becomes a partial, and is merged with the others of
its exam; no other payload is read again, and no other exam's rows are written.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom.fixed_values import EXAM_KIND, KEY_KIND
from quizloom.functions.payload import decode_answers, decode_questions, good_pages
from quizloom.operators import assemble, hashed
from quizloom.operators.resume import append_new_pages, page_state, read_page_table
from quizloom.schemas import ALTERNATIVES_IN, BUILT_EXAM, BUILT_QUESTION, PAGE_TABLE, PARTIAL, PIECES
from quizloom.staging import scratch, staged
from quizloom.versions import forget, newest, publish

#: Parts of a question that one partial stitch holds at most.
MOST_PIECES = 10_000
TABLES = {"partials": (PARTIAL, "exam"), "questions": (BUILT_QUESTION, "exam_source"), "exams": (BUILT_EXAM, "exam")}


def ingest_new_pages(
    spark: SparkSession,
    drop_folder: str,
    page_table: str,
    checkpoint: str,
    files_per_batch: int = 1_000,
    quarantine: str | None = None,
) -> None:
    """Append the pages of new drop files, then stop.

    Drop files hold JSON lines ``exam, doc_kind, page, payload, failed``. The
    checkpoint remembers the files taken; a batch that is repeated after a failure
    adds nothing twice. Lines that can't be read or stored go, with the reason, to the
    table at ``quarantine``, by default ``<page_table>-quarantine``.
    """
    arriving = (
        spark.readStream.schema(f"{PAGE_TABLE}, failed boolean, _corrupt_record string")
        .option("maxFilesPerTrigger", files_per_batch)
        .json(drop_folder)
    )
    aside = quarantine or f"{page_table}-quarantine"
    query = (
        arriving.writeStream.foreachBatch(lambda batch, n: append_new_pages(batch, page_table, aside, n))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def question_state(spark: SparkSession, question_table: str) -> tuple[int, dict]:
    """The newest version of the question table, and its state: that of each table, and the pages taken."""
    version, state = newest(spark, question_table)
    return version, state or {"pages": 0, **{name: hashed.empty() for name in TABLES}}


def partial_stitches(pages: DataFrame) -> DataFrame:
    """Pages to what they add to questions: ``PARTIAL`` rows, mergeable in any order.

    A row holds at most ``MOST_PIECES`` parts of a question, so no question makes one too large.
    """
    exam_pages = pages.where(F.col("doc_kind") == EXAM_KIND)
    key_pages = pages.where(F.col("doc_kind") == KEY_KIND)
    parts = assemble.explode_questions(good_pages(decode_questions(exam_pages)))
    run = F.floor(F.monotonically_increasing_id() / MOST_PIECES)
    piece = F.struct("page", "pos", "enunciado")
    place = F.struct("page", "pos")
    questions = parts.withColumn("_run", run).groupBy("exam", "numero", "_run").agg(
        F.array_sort(F.collect_list(piece)).alias("pieces"),
        # The longest option list, the later one on a tie.
        F.max_by(F.struct("alternativas", "page", "pos"), F.struct(F.size("alternativas"), place)).alias("longest"),
    )
    answers = assemble.explode_answers(good_pages(decode_answers(key_pages)))
    first = answers.groupBy("exam", "numero").agg(F.min_by(F.struct("page", "pos", "resposta"), place).alias("first"))
    none = F.lit(None)
    stitched = questions.select("exam", "numero", "pieces", "longest.*", none.cast("string").alias("resposta"))
    no_lists = none.cast(PIECES).alias("pieces"), none.cast(ALTERNATIVES_IN).alias("alternativas")
    return stitched.unionByName(first.select("exam", "numero", *no_lists, "first.*"))


def merged_questions(partials: DataFrame) -> DataFrame:
    """Finished questions from all partials of their exams."""
    stitches = partials.where("pieces IS NOT NULL")
    at = (F.col("piece.page") == F.col("page")) & (F.col("piece.pos") == F.col("pos"))
    parts = stitches.select(
        "exam", "numero", F.explode("pieces").alias("piece"), "page", "pos", "alternativas"
    ).select(
        "exam", "numero", "piece.*",
        # A partial keeps one option list, which stands at its own part again.
        F.when(at, F.col("alternativas")).otherwise(F.array().cast(ALTERNATIVES_IN)).alias("alternativas"),
    )
    answers = partials.where("pieces IS NULL").select("exam", "numero", "page", "pos", "resposta")
    parts = staged(parts, "question-parts")
    return assemble.join_answers(assemble.merge_split_questions(parts), assemble.collect_answers(answers))


def touched_partials(spark: SparkSession, question_table: str, state: dict, exams: DataFrame) -> DataFrame:
    """Stored partials of ``exams``; only the buckets that hold these are read."""
    bucket = hashed.bucket_of(state["partials"], F.col("exam")).alias("bucket")
    buckets = [r["bucket"] for r in exams.select(bucket).distinct().collect()]
    stored = hashed.read(spark, state["partials"], question_table + "/partials", PARTIAL, buckets)
    return stored.drop("part", "bucket").join(exams, "exam", "left_semi")


def refresh_questions(spark: SparkSession, page_table: str, question_table: str) -> None:
    """Bring the question table up to the page table: rebuild the exams of pages that arrived since.

    Only those pages are decoded. Their partials join the stored ones of their exams, and these
    exams' questions are written under a new build, which takes the place of older ones when
    the new version is published; before that nothing changes, and a refresh that fails is
    made again.
    """
    version, state = question_state(spark, question_table)
    pages, _ = page_state(spark, page_table)
    if pages == state["pages"]:
        return
    build = version + 1
    after = state | {"pages": pages}
    with scratch(spark):
        fresh = staged(partial_stitches(read_page_table(spark, page_table, after=state["pages"])), "partials")
        exams = fresh.select("exam").distinct()
        rows = merged_questions(touched_partials(spark, question_table, state, exams).unionByName(fresh))
        numbered = F.lit(build).cast("long").alias("build")
        new = {"partials": fresh, "questions": rows.select("*", numbered), "exams": exams.select("*", numbered)}
        most = fresh.count()
        for name, (_, key) in TABLES.items():
            before = state[name]
            if not before["buckets"]:
                before = hashed.with_buckets(before, -(-most // hashed.ROWS_PER_BUCKET))
            table = new[name].withColumn("bucket", hashed.bucket_of(before, F.col(key)))
            counts, _ = hashed.write_part(table, f"{question_table}/{name}", build)
            after[name] = hashed.added(before, counts, build, 0)
    publish(spark, question_table, build, after)
    arrange_questions(spark, question_table)


def newest_builds(spark: SparkSession, question_table: str, state: dict) -> DataFrame:
    """The newest build of each exam: ``exam, build``."""
    builds = hashed.read(spark, state["exams"], question_table + "/exams", BUILT_EXAM)
    return builds.groupBy("exam").agg(F.max("build").alias("build"))


def built_questions(spark: SparkSession, question_table: str) -> DataFrame:
    """Questions of each exam's newest build, with its number in ``build``, at the version that is newest now."""
    _, state = question_state(spark, question_table)
    rows = hashed.read(spark, state["questions"], question_table + "/questions", BUILT_QUESTION)
    newest_build = newest_builds(spark, question_table, state).withColumnRenamed("exam", "exam_source")
    return rows.drop("part", "bucket").join(newest_build, ["exam_source", "build"], "left_semi")


def current_questions(spark: SparkSession, question_table: str) -> DataFrame:
    """``built_questions`` without the builds."""
    return built_questions(spark, question_table).drop("build")


def arrange_questions(
    spark: SparkSession,
    question_table: str,
    rows_per_bucket: int = hashed.ROWS_PER_BUCKET,
    most_parts: int = hashed.MOST_PARTS,
) -> None:
    """Split full buckets, and bring parts together where a bucket has more than ``most_parts``.

    Rows of older builds are left out on the way. Publishes a version if anything changed.
    """
    version, state = question_state(spark, question_table)
    after = dict(state)
    with scratch(spark):
        builds = newest_builds(spark, question_table, state)
        current = builds.withColumnRenamed("exam", "exam_source")
        keep = {
            "partials": None,
            "questions": lambda rows: rows.join(current, ["exam_source", "build"], "left_semi"),
            "exams": lambda rows: rows.groupBy("exam").agg(F.max("build").alias("build")).select("exam", "build"),
        }
        for name, (schema, key) in TABLES.items():
            after[name] = hashed.arranged(
                spark, state[name], f"{question_table}/{name}", schema, key, version + 1,
                rows_per_bucket=rows_per_bucket, most_parts=most_parts, keep=keep[name],
            )
    if after != state:
        publish(spark, question_table, version + 1, after)


def drop_superseded(spark: SparkSession, question_table: str) -> None:
    """Leave out the rows of older builds and delete the parts that held them. No reader may be at work on them."""
    arrange_questions(spark, question_table, most_parts=1)
    version, state = question_state(spark, question_table)
    forget(spark, question_table, version)
    for name in TABLES:
        hashed.drop_unnamed(spark, state[name], f"{question_table}/{name}")
