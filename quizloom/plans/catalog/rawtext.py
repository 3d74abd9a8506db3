"""Tagged raw text: generated from the tables, then parsed back."""

from pyspark.sql import functions as F

from quizloom.functions import text
from quizloom.functions.rows import rows_of_list
from quizloom.operators import rawtext as parsing
from quizloom.plans.catalog.registry import query, table
from quizloom.sources.files import raw_blocks
from quizloom.staging import staged, staging_path

STEM = "concat(2000 + doc_id % 20, '-', lpad(cast(doc_id % 25 + 1 as string), 2, '0'), if(doc_id % 3 = 0, 'a', ''))"

# One block per line of a document. Blank lines give blocks without a statement.
# "Questão de ordem" opens no block, since no number follows.
BLOCK = """concat('Questão ', i + 1, if(i % 5 = 4, ' NULL', ''), '\n\n',
    if(i % 7 = 6, '', concat('AREA ', if(i % 2 = 0, 'ETHICS', 'PHILOSHOPY '), '\n\n')),
    line, '\n\n', if(trim(line) = '' or i % 3 > 0, '', 'Questão de ordem\n'), 'OPTIONS\n\nA',
    if(i % 2 = 0, ':CORRECT', ''), ') ', length(line), '\n\nB', if(i % 4 = 0, ':CORRECT', ''),
    ')  ', line, '\nend\n')"""
FILE_TEXT = f"array_join(transform(split(text, '\n'), (line, i) -> {BLOCK}), '\n')"

PARSED_SQL = """
    WITH l AS (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
            unnest(range(len(string_split(text, chr(10))))) AS i FROM documents),
    t AS (SELECT *, regexp_replace(line, '^\\s+|\\s+$', '', 'g') AS clean FROM l)
    SELECT {stem} AS stem, printf('oab-%d', edition) AS exam_source,
        (i + 1)::bigint AS question_number, printf('oab-%d-%03d', edition, i + 1) AS id,
        md5(clean || CASE WHEN i % 3 = 0 THEN ' Questão de ordem' ELSE '' END) AS statement_md5,
        CASE WHEN i % 7 = 6 THEN 'NI' WHEN i % 2 = 0 THEN 'ETHICS' ELSE 'PHILOSOPHY' END AS area,
        CASE WHEN i % 5 = 4 THEN NULL WHEN i % 4 = 0 THEN 'B' WHEN i % 2 = 0 THEN 'A' END
            AS correct_answer,
        i % 5 = 4 AS nullified, 2 AS n_alternatives, length(line)::varchar AS first_text,
        md5(clean || ' end') AS second_md5
    FROM (SELECT *, {edition} AS edition FROM t) WHERE clean <> ''
"""


def parsed_columns(rows, *more):
    alternative = F.col("alternatives")
    return rows.select(
        "stem",
        "exam_source",
        "question_number",
        "id",
        F.md5("statement").alias("statement_md5"),
        "area",
        "correct_answer",
        "nullified",
        F.size(alternative).alias("n_alternatives"),
        F.get(alternative, F.lit(0))["text"].alias("first_text"),
        F.md5(F.get(alternative, F.lit(1))["text"]).alias("second_md5"),
        *more,
    )


def raw_texts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        F.expr(STEM).alias("stem"), F.expr(FILE_TEXT).alias("value")
    )


@query(
    PARSED_SQL.format(
        stem="""concat(2000 + doc_id % 20, '-', lpad((doc_id % 25 + 1)::varchar, 2, '0'),
            CASE WHEN doc_id % 3 = 0 THEN 'a' ELSE '' END)""",
        edition="doc_id % 25 + 1",
    )
)
def parse_raw_text(spark, sf_dir):
    """One text per document, a question per line."""
    blocks = parsing.blocks_of_texts(raw_texts(spark, sf_dir))
    return parsed_columns(parsing.good_questions(parsing.parse_blocks(blocks)))


@query(
    """
    WITH l AS (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
    t AS (SELECT doc_id, regexp_replace(line, '^\\s+|\\s+$', '', 'g') = '' AS blank FROM l),
    r AS (
        SELECT CASE WHEN doc_id % 2 = 0 THEN 'bad header' ELSE 'empty block' END AS reason FROM documents
        UNION ALL SELECT 'no options' FROM documents
        UNION ALL SELECT 'empty statement' FROM documents WHERE doc_id % 3 = 0
        UNION ALL SELECT CASE WHEN blank THEN 'empty statement' ELSE 'bad file name' END
        FROM t WHERE blank OR doc_id % 7 = 0)
    SELECT reason, count(*) AS blocks FROM r GROUP BY reason
    """
)
def rejected_blocks(spark, sf_dir):
    """Every reason: a preamble, blank or not, blocks without options or statement, names without a year."""
    value = """concat(if(doc_id % 2 = 0, 'intro', ''), '\n', {text}, '\nQuestão 999\n\nsem opções\n',
        if(doc_id % 3 = 0, 'Questão 998\n\nAREA ETHICS\n\nOPTIONS\n\nA) x\n', ''))"""
    texts = table(spark, sf_dir, "documents").select(
        F.expr(f"if(doc_id % 7 = 0, 'notes', {STEM})").alias("stem"),
        F.expr(value.format(text=FILE_TEXT)).alias("value"),
    )
    rejected = parsing.rejected_blocks(parsing.parse_blocks(parsing.blocks_of_texts(texts)))
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("blocks"))


FILES_SQL = """
    SELECT *, NULL::varchar AS reason FROM ({good})
    UNION ALL BY NAME
    SELECT printf('%d-%02d', 2000 + g, g % 25 + 1) AS stem, unnest(['bad header', 'no options']) AS reason,
        unnest([md5('intro ' || g), md5('Questão 999' || chr(10) || chr(10) || 'sem opções')]) AS statement_md5
    FROM (SELECT DISTINCT doc_id // 500 AS g FROM documents)
"""


@query(
    FILES_SQL.format(
        good=PARSED_SQL.format(
            stem="printf('%d-%02d', 2000 + doc_id // 500, doc_id // 500 % 25 + 1)",
            edition="doc_id // 500 % 25 + 1",
        )
    )
)
def raw_text_files(spark, sf_dir):
    """The same texts, five hundred to a file, with preambles and all line ends, read in splits that cut blocks."""
    folder = staging_path(spark, "raw-text")
    texts = table(spark, sf_dir, "documents").select(
        F.expr("doc_id div 500").alias("g"), "doc_id", F.expr(FILE_TEXT).alias("value")
    )
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "value"))), lambda x: x["value"])
    joined = texts.groupBy("g").agg(F.array_join(in_order, "\n").alias("value"))
    whole = F.expr("concat('intro ', g, '\n', value, '\nQuestão 999\n\nsem opções')")
    end = F.expr("element_at(array('\n', '\r\n', '\r'), cast(g % 3 + 1 as int))")
    stem = F.expr("format_string('%d-%02d', 2000 + g, g % 25 + 1)").alias("stem")
    joined.select(stem, F.replace(whole, F.lit("\n"), end).alias("value")).write.partitionBy("stem").text(folder)
    # A session of its own, for splits far smaller than the files.
    small = spark.newSession()
    small.conf.set("spark.sql.files.maxPartitionBytes", "500k")
    small.conf.set("spark.sql.files.openCostInBytes", "0")
    parsed = parsing.parse_blocks(raw_blocks(small, folder, stem_from="folder"))
    # Parsed once for both; of the texts only those of rejected blocks are kept.
    rejected = F.when(F.col("reason").isNotNull(), F.col("block")).alias("block")
    parsed = staged(parsed_columns(parsed, "reason", rejected), "raw-parsed")
    good = parsing.good_questions(parsed)
    bad = parsing.rejected_blocks(parsed).select("stem", "reason", F.md5("block").alias("statement_md5"))
    return good.unionByName(bad, allowMissingColumns=True)


OPTIONS_TEXT = """concat('A) ', p_name, '\nB', if(p_size % 2 = 0, ':CORRECT', ''), ')\t', p_brand,
    ' \n ', p_type, '\n\nC)', if(p_size % 3 = 0, '', p_name), '\nD', if(p_size % 5 = 0, ':CORRECT', ''),
    ') ', p_type, '\n')"""
# An option without a text takes the next marker line as its text.
OPTIONS_SQL = """
    WITH a AS (
        SELECT p_partkey, 0 AS pos, 'A' AS letter, p_name AS text, false AS tagged FROM part
        UNION ALL SELECT p_partkey, 1, 'B', p_brand || ' ' || p_type, p_size % 2 = 0 FROM part
        UNION ALL SELECT p_partkey, 2, 'C', CASE WHEN p_size % 3 = 0 THEN 'D'
            || CASE WHEN p_size % 5 = 0 THEN ':CORRECT' ELSE '' END || ') ' || p_type
            ELSE p_name END, false FROM part
        UNION ALL SELECT p_partkey, 3, 'D', p_type, p_size % 5 = 0 FROM part WHERE p_size % 3 <> 0)
"""


def part_alternatives(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", text.alternatives(F.expr(OPTIONS_TEXT)).alias("alts")
    )


@query(OPTIONS_SQL + "SELECT * FROM a")
def parse_alternatives(spark, sf_dir):
    rows = rows_of_list(part_alternatives(spark, sf_dir), ["p_partkey"], "alts")
    return rows.select("p_partkey", "pos", "item.letter", "item.text", "item.tagged")


@query(
    OPTIONS_SQL
    + """SELECT p_partkey, arg_max(letter, pos) FILTER (WHERE tagged) AS correct_letter
    FROM a GROUP BY p_partkey"""
)
def correct_letter(spark, sf_dir):
    """The last tagged option counts; none gives null."""
    return part_alternatives(spark, sf_dir).select(
        "p_partkey", text.tagged_letter(F.col("alts")).alias("correct_letter")
    )


@query(
    """
    SELECT doc_id, md5(regexp_replace(regexp_replace(text, '\\s*\\n\\s*', ' ', 'g'),
        '^\\s+|\\s+$', '', 'g')) AS text_md5 FROM documents
    """
)
def collapse_whitespace(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(text.one_line(F.col("text"))).alias("text_md5")
    )
