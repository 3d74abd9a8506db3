"""Document fingerprints by Order MinHash, in DataFrame functions only.

A text is a sequence of tokens (words, long ones cut into pieces of ``LONGEST``
characters), and its k-mers are ``KMER`` tokens in a row. The i-th occurrence of a k-mer
counts as an element of its own, so repeats matter. An element has a hash, a point on a
ring of 2^63. Sketch j of ``SKETCHES`` orders all elements by where they lie on the ring
after its own starting point, selects the ``LENGTH`` minimal ones, puts them back into the
order in which they stand in the text, and hashes the tuple. Two texts agree in a sketch
only if the same k-mers are minimal *and* stand in the same order; the share of equal
sketches is the likeness, which falls with the edit distance where plain MinHash, blind to
order and repeats, does not.

One sort of the elements serves all sketches: their orders are rotations of one hash. Each
order is min-wise for its own, and sketches whose starting points fall between the same two
elements agree with each other, so short texts have fewer independent sketches.

All steps work within a row: a text's elements are an array of numbers, each a hash with
the place in its low bits, and never a row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizloom.operators.ordering import with_position
from quizloom.staging import staged

SKETCHES = 32
LENGTH = 2
KMER = 3
#: Words are cut into tokens of at most so many characters; scripts without blanks have long ones.
LONGEST = 16
#: Bits of the ring that name a sketch's starting point.
_RING_BITS = 63


def tokens(text: Column, longest: int = LONGEST) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"([^\x20\x09-\x0D]{{1,{longest}}})"))


def ring(value: Column) -> Column:
    """A hash as a point from 0 to 2^63 - 1."""
    return F.shiftrightunsigned(value, 1)


def with_fingerprint(
    df: DataFrame,
    text: Column,
    name: str = "sketches",
    sketches: int = SKETCHES,
    length: int = LENGTH,
    kmer: int = KMER,
    longest: int = LONGEST,
) -> DataFrame:
    """``df`` with the sketches of ``text``, an array of ``sketches`` ints; ``sketches`` is a power of two.

    Equal texts have equal sketches. Texts with fewer than ``kmer`` tokens have one k-mer of all
    of them; those with none, null ones too, share one fingerprint. Columns that start with
    ``_omh`` are used on the way. The row holds a text's tokens and some numbers for each.
    """
    kept = df.columns
    bins = sketches.bit_length() - 1
    if sketches < 1 or sketches != 1 << bins:
        raise ValueError("the number of sketches must be a power of two")
    at = lambda column: F.col(f"_omh_{column}")
    step = df.withColumn("_omh_tokens", F.transform(tokens(F.coalesce(text, F.lit("")), longest), lambda t: F.xxhash64(t)))
    n_tokens = F.size(at("tokens"))
    n = F.when(n_tokens == 0, 0).otherwise(F.greatest(n_tokens - kmer + 1, F.lit(1)))
    # Places take as many low bits as the text needs; the hash keeps those above them.
    step = step.withColumn("_omh_n", n)
    step = step.withColumn("_omh_low", F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(at("n")))) - 1)
    window = lambda i: [F.get(at("tokens"), i + j) for j in range(kmer)]
    marked = F.transform(
        F.sequence(F.lit(0), at("n") - 1),
        lambda i: ring(F.xxhash64(*window(i))).bitwiseAND(F.bitwise_not(at("low"))).bitwiseOR(i.cast("long")),
    )
    step = step.withColumn(
        "_omh_marked", F.when(at("n") == 0, F.array().cast("array<bigint>")).otherwise(F.sort_array(marked))
    )
    # Sorted, the occurrences of a k-mer stand together in the order of the text.
    key = lambda x: x.bitwiseAND(F.bitwise_not(at("low")))
    first = lambda x, i: (i == 0) | (key(F.get(at("marked"), i - 1)) != key(x))
    step = step.withColumn("_omh_firsts", F.filter(at("marked"), first))
    repeats = F.filter(at("marked"), lambda x, i: ~first(x, i))
    none = F.array().cast("array<bigint>")
    step = step.withColumn("_omh_repeats", F.when(F.size(at("firsts")) == at("n"), none).otherwise(repeats))
    # The first occurrence is the k-mer's own point; a later one's is hashed with its number. A run of
    # repeats begins where the k-mer changes, and its numbers are the places counted from there.
    begins = F.filter(
        F.sequence(F.lit(0), F.size(at("repeats"))),
        lambda i: (i == 0) | (i == F.size(at("repeats")))
        | (key(F.get(at("repeats"), i - 1)) != key(F.get(at("repeats"), i))),
    )
    step = step.withColumn("_omh_begins", F.when(F.size(at("repeats")) == 0, F.array().cast("array<int>")).otherwise(begins))
    numbers = F.flatten(
        F.transform(
            F.slice(at("begins"), F.lit(1), F.greatest(F.size(at("begins")) - 1, F.lit(0))),
            lambda b, r: F.sequence(F.lit(1), F.get(at("begins"), r + 1) - b),
        )
    )
    place = lambda x: x.bitwiseAND(at("low"))
    later = F.zip_with(
        at("repeats"),
        numbers,
        lambda x, number: ring(F.xxhash64(*window(place(x).cast("int")), number))
        .bitwiseAND(F.bitwise_not(at("low")))
        .bitwiseOR(place(x)),
    )
    start = lambda x: F.shiftright(x, _RING_BITS - bins)

    def leading(points: Column) -> Column:
        """The first ``length`` points after each starting point; other ones are minimal in no sketch."""
        return F.filter(points, lambda x, i: (i < length) | (start(F.get(points, i - length)) != start(x)))

    step = step.withColumn("_omh_later", F.sort_array(later))
    both = F.concat(leading(at("firsts")), leading(at("later")))
    step = step.withColumn("_omh_points", F.sort_array(both))
    step = step.withColumn("_omh_points", leading(at("points")))
    # The tuple is of the k-mers that stand at the points' places, in text order.
    after = lambda j: F.concat(F.filter(at("points"), lambda x: start(x) >= j), at("points"))
    order = lambda j: F.array_sort(F.array_distinct(F.transform(F.slice(after(j), 1, length), place)))
    signature = F.transform(
        F.sequence(F.lit(0), F.lit(sketches - 1)),
        lambda j: F.shiftright(F.xxhash64(F.transform(order(j), lambda p: F.xxhash64(*window(p.cast("int"))))), 32).cast("int"),
    )
    return step.withColumn(name, signature).select(*kept, name)


def likeness(one: Column, other: Column) -> Column:
    """The share of equal sketches, 0 to 1."""
    equal = F.filter(F.zip_with(one, other, lambda a, b: a == b), lambda same: same)
    return F.size(equal) / F.size(one)


def as_hex(sketches: Column) -> Column:
    """Eight hex digits for each sketch."""
    digits = F.transform(sketches, lambda x: F.lower(F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")))
    return F.array_join(digits, "")


def chained(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Rows with their successor, and their texts, by the row's place in the table.

    The first table has ``row``, ``key``, ``n_chars`` and ``next`` (the successor's row: the next
    in order of key, null keys last, then of the text's hash; the last row's is the first), the
    second ``row`` and ``text`` (null: empty). Reading the table again must give the same rows
    in the same order, as files do; stage what comes out of a shuffle first.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), body.alias("text"))
    short = numbered.select("row", "key", F.length("text").cast("long").alias("n_chars"), F.xxhash64("text").alias("hash"))
    # Written before it is sorted, so that sampling for the sort reads no text.
    short = staged(short, "omh-rows")
    order = [F.col("key").asc_nulls_last(), F.col("hash").asc(), F.col("row").asc()]
    placed = staged(with_position(short, order, "position").select("row", "key", "n_chars", "position"), "omh-order")
    rows = placed.count()
    before = F.when(F.col("position") == 1, F.lit(rows)).otherwise(F.col("position") - 1)
    following = placed.select(before.alias("position"), F.col("row").alias("next"))
    return staged(placed.join(following, "position").drop("position"), "omh-next"), numbered.select("row", "text")


def fingerprint_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The fingerprint of each text, of its edited text, and how alike they are.

    In the edited text the last quarter (``floor(n_chars / 4)`` code points) gives way to the
    first as many code points of the next document, in order of the key; the last document
    is followed by the first. Columns: ``key``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint`` (hex), ``near_edited``, ``near_next`` (likeness, 0 to 1).

    Null texts count as empty; texts without a word have one fingerprint in common, so two of
    them are alike. Rows with a null key come last in the order, those of equal keys in order
    of their texts' hash; repeated rows are documents of their own. A text and its tokens are
    held by one task, about 40 bytes for each byte of text. An empty table gives an empty
    table; other columns are not read.
    """
    rows, texts = chained(docs, key, text)
    # Both joins read one exchange of the texts; what moves a second time is quarters.
    wanted = rows.select(
        F.col("next").alias("row"), F.col("row").alias("to"), F.floor(F.col("n_chars") / 4).cast("int").alias("quarter")
    )
    heads = texts.join(wanted, "row").select(F.col("to").alias("row"), F.expr("left(text, quarter)").alias("head"), "quarter")
    edited = F.concat(F.expr("left(text, length(text) - quarter)"), "head")
    both = texts.join(heads, "row").select("row", "text", edited.alias("edited"))
    marked = with_fingerprint(with_fingerprint(both, F.col("text"), "own"), F.col("edited"), "changed")
    found = staged(
        marked.select("row", "own", "changed", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256")),
        "omh-sketches",
    )
    following = found.select(F.col("row").alias("next"), F.col("own").alias("next_own"))
    return (
        found.join(rows, "row")
        .join(following, "next")
        .select(
            F.col("key").alias(key),
            "n_chars",
            "edited_sha256",
            as_hex(F.col("own")).alias("fingerprint"),
            as_hex(F.col("changed")).alias("edited_fingerprint"),
            likeness(F.col("own"), F.col("changed")).alias("near_edited"),
            likeness(F.col("own"), F.col("next_own")).alias("near_next"),
        )
    )
