"""Markup, embedded JSON, postal codes and request addresses."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, functions as F, types as T

from ..schemas import ADDRESS_FIELDS, DETAIL_FIELDS

# Patterns of the landed documents.
# Without a group around the whole, so that the pattern starts with plain text, which is found faster.
ADDRESS_PATTERN = r"\{&quot;address&quot;:.*?\}"
DETAIL_PATTERN = r'"adDetail"\s*:\s*(\{.*?\})'
BLOCK_PATTERN = "(?i)are you a human"
CARD_PATTERN = r"(?s)<section\b[^>]*\badcard\b[^>]*>(.*?)</section>"
LINK_PATTERN = r"""(?s)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["']"""
TITLE_PATTERN = r"(?s)<h2\b[^>]*>(.*?)</h2>"
RESULT_PATTERN = (
    r"(?s)<p\b(?=[^>]*\btypo-body-small\b)(?=[^>]*\bfont-regular\b)(?=[^>]*\btext-neutral-110\b)[^>]*>(.*?)</p>"
)
# Named entities: the Latin-1 ones and common punctuation, from Python's table; the ampersand comes last.
PUNCTUATION = {"ndash", "mdash", "lsquo", "rsquo", "ldquo", "rdquo", "bull", "hellip", "euro", "trade"}
ENTITIES = {
    "&apos;": "'",
    **{f"&{n};": chr(c) for n, c in name2codepoint.items() if (c < 256 or n in PUNCTUATION) and n != "amp"},
    "&amp;": "&",
}
SPACE = r"[\s\u00a0]"

CORRUPT = "_corrupt"


def _decode_numbered(text: Column) -> Column:
    """Character references by number, decimal or hexadecimal; others stay as they are."""

    def char(part: Column, code: Column, head: str) -> Column:
        letter = F.decode(F.unhex(F.lpad(code, 8, "0")), "UTF-32")
        return F.concat(letter, F.regexp_replace(part, head, ""))

    # Up to 10FFFF, with any number of leading zeros.
    decimal = r"^0*(11141(?:0[0-9]|1[01])|11140[0-9]{2}|111[0-3][0-9]{3}|110[0-9]{4}|10[0-9]{5}|[0-9]{1,6});"
    hexadecimal = r"^[xX]0*((?:10|[0-9a-fA-F])?[0-9a-fA-F]{1,4});"

    def resolve(part: Column) -> Column:
        return (
            F.when(part.rlike(decimal), char(part, F.hex(F.regexp_extract(part, decimal, 1).cast("int")), decimal))
            .when(part.rlike(hexadecimal), char(part, F.regexp_extract(part, hexadecimal, 1), hexadecimal))
            .otherwise(F.concat(F.lit("&#"), part))
        )

    parts = F.split(text, "&#")
    return F.concat(F.element_at(parts, 1), F.array_join(F.transform(F.slice(parts, F.lit(2), F.size(parts) - 1), resolve), ""))


def decode_entities(text: Column) -> Column:
    """Character references replaced; text without any passes through untouched."""
    table = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(c).alias("char")) for n, c in ENTITIES.items()])
    numbered = F.when(text.contains("&#"), _decode_numbered(text)).otherwise(text)
    named = F.aggregate(table, numbered, lambda t, e: F.replace(t, e["name"], e["char"]))
    return F.when(text.contains("&"), named).otherwise(text)


def plain_text(markup: Column) -> Column:
    """Text of a markup fragment: tags removed, character references decoded, ends trimmed."""
    return decoded_and_trimmed(without_tags(markup))


def without_tags(markup: Column) -> Column:
    return F.regexp_replace(markup, "<[^>]*>", "")


def decoded_and_trimmed(text: Column) -> Column:
    return F.regexp_replace(decode_entities(text), f"^{SPACE}+|{SPACE}+$", "")


def result_text(html: Column, pattern: str = RESULT_PATTERN) -> Column:
    """Text of the first element that tells how many ads a search found; NULL when absent."""
    return F.when(html.rlike(pattern), plain_text(F.regexp_extract(html, pattern, 1)))


def first_match(text: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match (0: the whole), NULL when there is none."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def usable_page(status: Column, html: Column) -> Column:
    """True for a page that came back whole and is no robot check."""
    return F.coalesce((status == 200) & html.isNotNull() & ~html.rlike(BLOCK_PATTERN), F.lit(False))


def json_struct(text: Column, fields: list[str]) -> Column:
    """String fields of a JSON object; every field NULL when the text is not valid JSON.

    The extra field `_corrupt` holds text that did not parse.
    """
    schema = T.StructType([T.StructField(f, T.StringType()) for f in [*fields, CORRUPT]])
    return F.from_json(text, schema, {"columnNameOfCorruptRecord": CORRUPT})


def address_json(html: Column) -> Column:
    return F.replace(first_match(html, ADDRESS_PATTERN, 0), F.lit("&quot;"), F.lit('"'))


def detail_json(html: Column) -> Column:
    return first_match(html, DETAIL_PATTERN)


def parsed_address(json: Column) -> Column:
    return json_struct(json, list(ADDRESS_FIELDS))


def parsed_detail(json: Column) -> Column:
    return json_struct(json, list(DETAIL_FIELDS))


def address_struct(html: Column) -> Column:
    return parsed_address(address_json(html))


def detail_struct(html: Column) -> Column:
    return parsed_detail(detail_json(html))


def all_null(*cols: Column) -> Column:
    return F.coalesce(*cols).isNull()


def standard_cep(cep: Column) -> Column:
    """Postal code as NNNNN-NNN; NULL when it holds no digit or more than eight."""
    digits = F.regexp_replace(cep, "[^0-9]", "")
    padded = F.lpad(digits, 8, "0")
    shaped = F.concat(F.substring(padded, 1, 5), F.lit("-"), F.substring(padded, 6, 3))
    return F.when(F.length(digits).between(1, 8), shaped)


WIDE, NARROW = 1000.0, 100.0


def buffer_radius(cep: Column, wide: float = WIDE, narrow: float = NARROW) -> Column:
    """Metres around an ad: wide for postal codes that name a whole town (suffix 000)."""
    return F.when(cep.rlike("000$"), F.lit(wide)).otherwise(F.lit(narrow))


def search_url(base: str, low: Column, high: Column, page: Column) -> Column:
    """Request address of one page of one price band."""
    return F.concat(
        F.lit(f"{base}?ps="), low.cast("bigint").cast("string"), F.lit("&pe="), high.cast("bigint").cast("string"),
        F.lit("&o="), page.cast("string"),
    )


def geocoder_url(base: str, cep: Column, country: str = "BR") -> Column:
    return F.format_string(f"{base}?address=%s&components=country:{country}", F.url_encode(cep))


def snapshot_stamp(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")
