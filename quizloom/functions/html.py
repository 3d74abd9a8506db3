"""Column functions for links in stored HTML."""

import html.entities

from pyspark.sql import Column
from pyspark.sql import functions as F

from quizloom.functions.text import strip

# A page from left to right: every alternative ends where the next token begins. Loops that hold
# alternatives are possessive, so that a tag of any length is matched without recursion.
SPACE = r"[\t\n\r\f ]"
VALUE = rf"{SPACE}*+={SPACE}*+(\"[^\"]*+\"|'[^']*+'|(?![\"'])[^\t\n\r\f >]*+)"
NAME = r"([^\t\n\r\f />][^\t\n\r\f />=]*+)"
#: An attribute: its name, and its value with its quotes.
ATTRIBUTE = rf"{NAME}(?:{VALUE})?+"
TAG_START = rf"<[a-z][^\t\n\r\f />]*+(?:{SPACE}++|/(?!>)|{ATTRIBUTE})*+"
RAW_TAG = rf"(?:(?=<(?:script|style)[\t\n\r\f />]){TAG_START}>)"
TOKEN = (
    r"(?is)<!--.*?(?:-->|\z)"
    rf"|(?:(?=<script[\t\n\r\f />]){TAG_START}>).*?(?=</script[\t\n\r\f />]|\z)"
    rf"|(?:(?=<style[\t\n\r\f />]){TAG_START}>).*?(?=</style[\t\n\r\f />]|\z)"
    rf"|{TAG_START}/?>"
    r"|</[a-z][^>]*>|<[!?/][^>]*>|[^<]+|<"
)


def _character(reference: Column) -> Column:
    """The character named by ``#233``, ``#xE9`` or ``eacute``; null if unknown."""
    names = html.entities.name2codepoint | {"apos": ord("'")}
    named = F.element_at(
        F.create_map(*[F.lit(x) for name, code in names.items() for x in (name, chr(code))]),
        reference,
    )
    is_hex = reference.rlike(r"\A#[xX][0-9a-fA-F]{1,6}\z")
    is_decimal = reference.rlike(r"\A#[0-9]{1,7}\z")
    as_hex = F.when(is_hex, F.substring(reference, 3, 6)).when(
        is_decimal, F.hex(F.substring(reference, 2, 7).try_cast("long"))
    )
    numbered = F.decode(F.unhex(F.lpad(as_hex, 8, "0")), "UTF-32")
    return F.when(F.startswith(reference, F.lit("#")), numbered).otherwise(named)


def unescape(text: Column) -> Column:
    """Replace character references that end in a semicolon."""
    pieces = F.split(text, "&")

    def resolve(piece: Column, i: Column) -> Column:
        reference = F.regexp_extract(piece, r"\A(#?[0-9A-Za-z]+);", 1)
        character = F.when(reference != "", _character(reference))
        rest = F.substring(piece, F.length(reference) + 2, F.length(piece))
        return (
            F.when(i == 0, piece)
            .when(character.isNotNull(), F.concat(character, rest))
            .otherwise(F.concat(F.lit("&"), piece))
        )

    joined = F.array_join(F.transform(pieces, resolve), "")
    return F.when(F.contains(text, F.lit("&")), joined).otherwise(text)


def _attribute(tag: Column, name: str) -> Column:
    """The value of an attribute of an opening tag, the last one if it is repeated; null without a value."""
    attributes = F.regexp_replace(tag, r"(?is)\A<[a-z][^\t\n\r\f />]*+", "")
    pattern = F.lit(rf"(?is){ATTRIBUTE}")

    def last(names: Column) -> Column:
        place = F.size(names) - F.array_position(F.reverse(names), F.lit(name)).cast("int")
        raw = F.get(F.regexp_extract_all(attributes, pattern, F.lit(2)), place)
        bare = F.regexp_replace(raw, r"(?s)\A([\"'])(.*)\1\z", "$2")
        return F.when(F.array_contains(names, name) & (raw != ""), unescape(bare))

    names = F.transform(F.regexp_extract_all(attributes, pattern, F.lit(1)), F.lower)
    return F.get(F.transform(F.array(names), last), F.lit(0))


TEXT, RAW, OPEN, CLOSE, WHOLE, OTHER = range(6)


def _token(token: Column, place: Column, needle: str) -> Column:
    """What a token does to the link at hand: ``kind``, ``value`` (text or href) and ``place``."""
    is_anchor = token.rlike(r"(?i)\A<a[\t\n\r\f />]")
    is_raw = token.rlike(rf"(?is)\A{RAW_TAG}")

    def judged(href: Column) -> Column:
        wanted = F.contains(F.lower(href), F.lit(needle.lower()))
        ended = F.regexp_replace(token, rf"(?is)\A{TAG_START}", "") == "/>"
        kind = (
            F.when(~F.startswith(token, F.lit("<")) | (token == "<"), TEXT)
            .when(token.rlike(r"(?i)\A</a[\t\n\r\f />]"), CLOSE)
            .when(is_anchor & F.coalesce(wanted, F.lit(False)), F.when(ended, WHOLE).otherwise(OPEN))
            .when(is_anchor & ended, CLOSE)
            .when(is_raw, RAW)
            .otherwise(OTHER)
        )
        value = F.when(is_anchor, href).when(is_raw, F.regexp_replace(token, rf"(?is)\A{RAW_TAG}", "")).otherwise(token)
        return F.struct(kind.alias("kind"), value.alias("value"), place.alias("place"))

    href = F.when(is_anchor, _attribute(token, "href"))
    return F.get(F.transform(F.array(href), judged), F.lit(0))


def links(page: Column, needle: str = ".pdf") -> Column:
    """``array<struct<text, href>>`` of the anchors whose href holds ``needle``, in any case.

    The page is cut into tokens from left to right: text, tags with their quoted values,
    comments, declarations, and scripts and style sheets with all they hold. Each closing
    anchor tag ends at most one link: the last wanted opening tag since the closing tag
    before it, with the pieces of text that follow, joined by blanks. An anchor that closes
    itself is a link without text.
    """

    def in_tokens(tokens: Column) -> Column:
        closes = F.filter(tokens, lambda t: t["kind"].isin(CLOSE, WHOLE))

        def link(close: Column, n: Column) -> Column:
            start = F.when(n == 0, 0).otherwise(F.get(closes, n - 1)["place"] + 1)
            inside = F.slice(tokens, start + 1, close["place"] - start)
            opened = F.filter(inside, lambda t: t["kind"] == OPEN)

            def read(tag: Column) -> Column:
                data = F.filter(inside, lambda t: t["kind"].isin(TEXT, RAW) & (t["place"] > tag["place"]))
                pieces = F.transform(data, lambda t: F.when(t["kind"] == RAW, t["value"]).otherwise(unescape(t["value"])))
                pieces = F.filter(pieces, lambda piece: piece != "")
                return F.struct(strip(F.array_join(pieces, " ")).alias("text"), tag["value"].alias("href"))

            whole = F.struct(F.lit("").alias("text"), close["value"].alias("href"))
            last = F.transform(F.slice(opened, F.greatest(F.size(opened), F.lit(1)), F.lit(1)), read)
            return F.when(close["kind"] == WHOLE, F.array(whole)).otherwise(last)

        return F.flatten(F.transform(closes, link))

    tokens = F.transform(
        F.regexp_extract_all(page, F.lit(TOKEN), F.lit(0)), lambda token, place: _token(token, place, needle)
    )
    return F.get(F.transform(F.array(tokens), in_tokens), F.lit(0))


def site_root(url: Column) -> Column:
    """``scheme://host`` of an absolute URL."""
    return F.regexp_extract(url, r"\A([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)


def _plain_path(path: Column) -> Column:
    """Resolve ``.`` and ``..`` parts of a path that starts at the root."""
    parts = F.split(path, "/")
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == ".", done)
        .when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1))))
        .otherwise(F.concat(done, F.array(part))),
    )
    tail = F.when(F.element_at(parts, -1).isin(".", ".."), "/").otherwise("")
    return F.when(path.rlike(r"/\.\.?(/|\z)"), F.concat(F.array_join(kept, "/"), tail)).otherwise(
        path
    )


def resolve_url(href: Column, root: Column) -> Column:
    """Absolute form of ``href`` on a page whose site root is ``root``."""
    target = F.regexp_extract(href, r"(?s)\A([^?#]*)", 1)
    query = F.substring(href, F.length(target) + 1, F.length(href))
    path = F.when(F.startswith(target, F.lit("/")), target).otherwise(
        F.concat(F.lit("/"), target)
    )
    return (
        F.when(F.startswith(href, F.lit("http")), href)
        .when(href.rlike(r"\A[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(F.startswith(href, F.lit("//")), F.concat(F.substring_index(root, "//", 1), href))
        .otherwise(F.concat(root, _plain_path(path), query))
    )
