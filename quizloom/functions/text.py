"""Column functions for the tagged raw-text layout and for clean text.

Patterns use ``(?d)`` so that only ``\\n`` ends a line, and ``(?U)`` so that blanks
are the Unicode ones. Line ends must be normalised first (``unix_lines``).
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of the raw-text layout.
# Blocks begin with their header, so AREA and OPTIONS lines follow a line break.
# A literal start of the pattern lets the regex engine skip through the text.
BLOCK_START = r"(?U)\n(?=Questão\s+\d)"
HEADER = r"(?mdU)\A\s*Questão\s+(\d+(?:\s*NULL)?)\s*$"
AFTER_HEADER = r"(?mdsU)\A\s*Questão\s+\d+\s*(?:NULL)?\s*$(.*)"
AREA = "\nAREA"
OPTIONS_LINE = r"(?mdU)\nOPTIONS\s*$"
# A marker takes the rest of its line or, if that is blank, the next line with text.
MARKED_LINE = r"(?mdU)^([A-E])(:CORRECT)?\)\s*(.*)"
MARKER_START = r"(?d)\n(?=[A-E](?::CORRECT)?\))"

# More pieces than a text can have.
MANY = 1 << 30

# Fixed value: the characters that count as blanks when stripping.
BLANKS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def unix_lines(text: Column) -> Column:
    replaced = F.regexp_replace(text, r"\r\n?", "\n")
    return F.when(F.contains(text, F.lit("\r")), replaced).otherwise(text)


def strip(text: Column) -> Column:
    """Remove leading and trailing Unicode blanks."""
    return F.btrim(text, F.lit(BLANKS))


def one_line(text: Column) -> Column:
    """Turn each line break with its surrounding blanks into one space, then strip."""
    lines = F.transform(F.split(text, "\n"), strip)
    return F.array_join(F.filter(lines, lambda line: line != ""), " ")


def blocks(text: Column) -> Column:
    """Split before each line that opens a numbered question."""
    return F.split(text, BLOCK_START)


def header(block: Column) -> Column:
    """The header at the start of a block, from its number on: ``12`` or ``12 NULL``; else empty."""
    return F.regexp_extract(block, HEADER, 1)


def header_number(head: Column) -> Column:
    return F.regexp_extract(head, r"\A\d+", 0).try_cast("bigint")


def header_is_null(head: Column) -> Column:
    return F.endswith(head, F.lit("NULL"))


def _after_area(text: Column) -> Column:
    """What follows the first AREA word at the start of a line."""
    return F.substring(text, F.instr(text, AREA) + F.lit(len(AREA)), F.length(text))


def area_tag(block: Column) -> Column:
    """Rest of the first AREA line; empty when there is no such line."""
    tag = F.btrim(F.substring_index(_after_area(block), "\n", 1), F.lit(" \t"))
    return F.when(F.contains(block, F.lit(AREA)), tag).otherwise("")


def options_split(block: Column) -> Column:
    """Text before the OPTIONS line, then the alternatives; one item without the line."""
    return F.split(block, OPTIONS_LINE)


def statement(before_options: Column, block: Column) -> Column:
    """Text after the AREA line of the block, or after the header if it has none.

    An AREA line that only comes after OPTIONS leaves no statement.
    """
    rest = _after_area(before_options)
    below = F.substring(rest, F.length(F.substring_index(rest, "\n", 1)) + 1, F.length(rest))
    text = (
        F.when(F.contains(before_options, F.lit(AREA)), below)
        .when(F.contains(block, F.lit(AREA)), "")
        .otherwise(F.regexp_extract(before_options, AFTER_HEADER, 1))
    )
    return one_line(text)


def alternatives(options: Column) -> Column:
    """``array<struct<letter, text, tagged>>`` of the lettered lines.

    An alternative without text takes the next marker line as its own text.
    """
    lines = F.concat(F.lit("\n"), F.regexp_replace(options, MARKED_LINE, "$1$2) $3"))
    # The first piece is what stands before the first marker.
    marked = F.slice(F.split(lines, MARKER_START), F.lit(2), F.lit(MANY))

    def alternative(piece: Column) -> Column:
        tagged = F.substring(piece, 2, 9) == ":CORRECT)"
        text = F.substring(piece, F.when(tagged, 11).otherwise(3), F.length(piece))
        return F.struct(
            F.substring(piece, 1, 1).alias("letter"),
            one_line(text).alias("text"),
            tagged.alias("tagged"),
        )

    return F.transform(marked, alternative)


def tagged_letter(alts: Column) -> Column:
    """Letter of the last tagged alternative; null without a tag."""
    tagged = F.filter(alts, lambda a: a["tagged"])
    return F.get(tagged, F.size(tagged) - 1)["letter"]


def plain_alternatives(alts: Column) -> Column:
    return F.transform(
        alts, lambda a: F.struct(a["letter"].alias("letter"), a["text"].alias("text"))
    )
