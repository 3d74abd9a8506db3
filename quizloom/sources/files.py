"""Scans of document folders, raw text, page payloads, datasets and manifests.

Spark skips empty files, and files and folders whose name starts with ``.`` or
``_``; give such a folder as the path itself to read it.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quizloom import schemas
from quizloom.fixed_values import EXAM_KIND, KEY_KIND
from quizloom.functions import names, payload, text
from quizloom.staging import staged


def document_listing(spark: SparkSession, folder: str) -> DataFrame:
    """``path, length`` of the PDF files in a folder; the bytes are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.pdf")
        .load(folder)
        .select("path", "length")
    )


def page_images(spark: SparkSession, folder: str, glob: str = "*.png") -> DataFrame:
    """``path, content`` of rendered page images below a folder."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path", "content")
    )


def _raw_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the ``*.txt`` files; ``\\n``, ``\\r\\n`` and ``\\r`` all end one."""
    return (
        spark.read.format("text")
        .option("pathGlobFilter", "*.txt")
        .load(folder)
        .select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("split_start"),
            # Only the order within a split is used: splits differ in their first bits.
            F.monotonically_increasing_id().alias("seq"),
            "value",
        )
    )


SPLIT = ["file_path", "split_start"]


def _pieces(lines: DataFrame) -> DataFrame:
    """What of a block one split holds: ``SPLIT, openers_after, opened, pending, first, piece``.

    A line opens a block if its number is on it, or on the next line with text. A line that waits
    for its number at the end of a split, the last one with text there, is ``pending``: it
    begins a piece of its own. ``first`` tells of the piece's first line with text whether a number
    begins it. All of it is done where the split's lines are, in one shuffle.
    """
    # Backwards, so that a frame grows row by row; one that shrinks is computed anew for each row.
    after = Window.partitionBy(*SPLIT).orderBy(F.desc("seq")).rowsBetween(Window.unboundedPreceding, -1)
    # Of lines with text, whether they begin with a number.
    numbered = lambda x: (x.rlike(r"(?U)\S"), x.rlike(r"(?U)\A\s*\d"))
    # The start of a line tells it as well, unless it is blank, and is read faster.
    start, named = F.left("value", F.lit(32)), F.startswith("value", F.lit("Questão"))
    lines = lines.withColumns(
        {
            "numbered": F.when(*numbered(start)).when(*numbered(F.col("value"))),
            "headed": named & F.col("value").rlike(r"(?U)\AQuestão\s+\d"),
            "bare": named & F.col("value").rlike(r"(?U)\AQuestão\s*\z"),
        }
    ).withColumn("following", F.last("numbered", ignorenulls=True).over(after))
    lines = lines.withColumns(
        {
            "pending": F.col("bare") & F.col("following").isNull(),
            "opener": F.col("headed") | (F.col("bare") & F.coalesce("following", F.lit(True))),
        }
    ).withColumn("openers_after", F.count_if("opener").over(after))
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("seq", "value"))), lambda x: x["value"])
    return lines.groupBy(*SPLIT, "openers_after").agg(
        F.bool_or("opener").alias("opened"),
        F.bool_or("pending").alias("pending"),
        F.min(F.when(F.col("numbered").isNotNull(), F.struct("seq", "numbered"))).alias("first"),
        F.array_join(in_order, "\n").alias("piece"),
    )


def _splits(pieces: DataFrame) -> DataFrame:
    """One row per split: ``SPLIT, openers, holds, opened_here, carried``.

    ``openers`` counts the pending one, ``holds`` says whether that opens a block, ``opened_here``
    are the blocks that begin in the split, and ``carried`` is the block open where it begins.
    """
    in_file = Window.partitionBy("file_path")
    later = in_file.orderBy(F.desc("split_start")).rowsBetween(Window.unboundedPreceding, -1)
    before = in_file.orderBy("split_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        pieces.groupBy(*SPLIT)
        .agg(
            F.max(F.col("openers_after") + F.col("opened").cast("int")).alias("openers"),
            F.bool_or("pending").alias("pending"),
            F.min("first")["numbered"].alias("first"),
        )
        .withColumn("next_text", F.last("first", ignorenulls=True).over(later))
    )
    holds = F.col("pending") & F.coalesce("next_text", F.lit(False))
    lost = (F.col("pending") & ~F.col("holds")).cast("int")
    splits = splits.withColumn("holds", holds).withColumn("opened_here", F.col("openers") - lost)
    open_block = F.when(
        F.col("opened_here") > 0, F.struct("split_start", F.col("opened_here").cast("long").alias("block_no"))
    )
    none_yet = F.struct(F.lit(0).cast("long").alias("split_start"), F.lit(0).cast("long").alias("block_no"))
    carried = F.coalesce(F.last(open_block, ignorenulls=True).over(before), none_yet)
    return splits.select(*SPLIT, "openers", "holds", "opened_here", carried.alias("carried"))


def raw_blocks(spark: SparkSession, folder: str, stem_from: str = "file") -> DataFrame:
    """Question blocks of the ``*.txt`` files of a folder.

    ``stem, file_path, split_start, block_no, block``; within a file, the columns
    before the block give its order. Files are read in parallel splits whatever their
    size; a block that goes on in later splits is put together again. Text before a
    file's first header is block 0 of its split 0. The stem is the file's name or, with
    ``stem_from="folder"``, that of its folder (``<stem>/`` or ``<key>=<stem>/``), as when
    the text was written by Spark.
    """
    if stem_from == "file":
        stem = names.file_stem(F.col("file_path"))
    elif stem_from == "folder":
        stem = F.regexp_extract("file_path", r"([^/=]+)/[^/]+\z", 1)
    else:
        raise ValueError(f"unknown stem source {stem_from!r}")
    # Read three times below: without the texts, and each text once.
    pieces = staged(_pieces(_raw_lines(spark, folder)), "raw-pieces")
    # A row per split, as many as the tasks that the driver plans to read them.
    placed = pieces.join(F.broadcast(_splits(pieces)), SPLIT).withColumn(
        "n", F.col("openers") - F.col("openers_after") - (F.col("pending") & ~F.col("holds")).cast("int")
    )
    # A block that ends in its split is one piece; only those at the borders meet others.
    whole = (F.col("n") > 0) & (F.col("n") < F.col("opened_here"))
    owner = F.when(F.col("n") > 0, F.struct("split_start", F.col("n").cast("long").alias("block_no"))).otherwise(F.col("carried"))
    placed = placed.select(
        "file_path", "split_start", "openers_after", owner.alias("owner"), whole.alias("whole"), F.col("piece").alias("block")
    )
    part = F.struct("split_start", F.negative("openers_after").alias("place"), "block")
    in_order = F.transform(F.sort_array(F.collect_list(part)), lambda x: x["block"])
    joined = placed.where("NOT whole").groupBy("file_path", "owner").agg(F.array_join(in_order, "\n").alias("block"))
    blocks = placed.where("whole").select("file_path", "owner", "block").unionByName(joined)
    return blocks.select(stem.alias("stem"), "file_path", "owner.*", "block")


PAGE_FILE = r"([^/]+)/([^/]+)/page-([0-9]+)\.json\z"


def page_files(spark: SparkSession, folder: str) -> DataFrame:
    """All ``page-*.json`` files below a folder: ``path, exam, doc_kind, page, payload, reason``.

    ``reason`` is null for ``<exam>/<kind>/page-NN.json`` with a known kind.
    """
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    files = (
        spark.read.format("text")
        .options(wholetext=True, pathGlobFilter="page-*.json", recursiveFileLookup=True)
        .load(folder)
        .select(path.alias("path"), F.col("value").alias("payload"))
    )
    exam, kind = (F.nullif(F.regexp_extract("path", PAGE_FILE, i), F.lit("")) for i in (1, 2))
    page = F.regexp_extract("path", PAGE_FILE, 3).try_cast("int")
    reason = (
        F.when(exam.isNull() | page.isNull(), "not <exam>/<kind>/page-NN.json")
        .when(~kind.isin(EXAM_KIND, KEY_KIND), "unknown kind")
    )
    return files.select(
        "path", exam.alias("exam"), kind.alias("doc_kind"), page.alias("page"), "payload", reason.alias("reason")
    )


def page_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """``exam, doc_kind, page, payload`` of the files whose names fit; ``page_files`` has the others."""
    return page_files(spark, folder).where("reason IS NULL").select("exam", "doc_kind", "page", "payload")


def question_dataset(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A JSONL dataset, or some of its files, checked as strictly as page payloads.

    Blank lines are skipped. A line that is no object, lacks a required field or has one
    of another type stops the read, and so does text after the object. Numbers may come as
    text; absent alternatives are an empty list, absent metadata an empty object.
    """
    return payload.checked_questions(spark.read.text(path))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """``edition, prova_url, gabarito_url`` from JSON objects keyed by edition."""
    return explode_manifest(spark.read.text(path, wholetext=True), "value")


def explode_manifest(documents: DataFrame, column: str) -> DataFrame:
    """Entries of the manifests; one that is no such object, or a key that is no number, stops the job."""
    parsed = F.from_json(F.col(column), schemas.MANIFEST_JSON, {"mode": "FAILFAST"})
    sound = F.coalesce(parsed, F.raise_error(F.lit("a manifest is no JSON object")).cast(schemas.MANIFEST_JSON))
    entries = documents.select(F.explode(sound).alias("key", "entry"))
    return entries.select(F.col("key").cast("int").alias("edition"), "entry.*")
