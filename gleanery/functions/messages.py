"""Tokens of short informal messages: emoticons, tags, handles, arrows and addresses stay whole."""

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values, as patterns that must match: the kinds of token in the order in which they are tried.
EMOTICON = (
    r"(?:[<>]?[:;=8][\-o\*\']?[\)\]\(\[dDpP/\:\}\{@\|\\]"
    r"|[\)\]\(\[dDpP/\:\}\{@\|\\][\-o\*\']?[:;=8][<>]?"
    r"|</?3)"
)
WEB_ADDRESS = (
    r"(?:https?:(?:/{1,3}|[a-z0-9%])|[a-z0-9.\-]+[.](?:[a-z]{2,13})/)"
    r"(?:[^\s()<>{}\[\]]+|\([^\s()]*?\([^\s()]+\)[^\s()]*?\)|\([^\s]+?\))+"
    r"(?:\([^\s()]*?\([^\s()]+\)[^\s()]*?\)|\([^\s]+?\)|[^\s`!()\[\]{};:'\".,<>?«»“”‘’])"
    r"|(?:(?<!@)[a-z0-9]+(?:[.\-][a-z0-9]+)*[.](?:[a-z]{2,13})\b/?(?!@))"
)
PHONE = r"(?:(?:\+?[01][ *\-.\)]*)?(?:[\(]?\d{3}[ *\-.\)]*)?\d{3}[ *\-.\)]*\d{4})"
OTHER = [
    r"<[^>\s]+>",
    r"[\-]+>|<[\-]+",
    r"(?:@[\w_]+)",
    r"(?:\#+[\w_]+[\w\'_\-]*[\w_]+)",
    r"[\w.+-]+@[\w-]+\.(?:[\w-]\.?)+[\w-]",
    r".(?:[\x{1F3FB}-\x{1F3FF}]?(?:\x{200D}.[\x{1F3FB}-\x{1F3FF}]?)+|[\x{1F3FB}-\x{1F3FF}])",
    r"[\x{1F1E6}-\x{1F1FF}]{2}",
    r"\x{1F3F4}\x{E0067}\x{E0062}\x{E0065}\x{E006E}\x{E0067}\x{E007F}",
    r"\x{1F3F4}\x{E0067}\x{E0062}\x{E0073}\x{E0063}\x{E0074}\x{E007F}",
    r"\x{1F3F4}\x{E0067}\x{E0062}\x{E0077}\x{E006C}\x{E0073}\x{E007F}",
    r"(?:[^\W\d_](?:[^\W\d_]|['\-_])+[^\W\d_])",
    r"(?:[+\-]?\d+[,/.:-]\d+[+\-]?)",
    r"(?:[\w_]+)",
    r"(?:\.(?:\s*\.){1,})",
    r"(?:\S)",
]
HANDLE = r"(?<![A-Za-z0-9_!@#\$%&*])@(([A-Za-z0-9_]){15}(?!@)|([A-Za-z0-9_]){1,14}(?![A-Za-z0-9_]*@))"
ENTITY = "&#?x?[^&;\\s]+;"


def _named() -> Column:
    """Characters by the names of their entities, from the standard library's table."""
    pairs = [F.lit(x) for name, point in name2codepoint.items() for x in (name, chr(point))]
    return F.create_map(*pairs)


def _windows() -> Column:
    """Numbers 0x80 to 0x9F are read as bytes of Windows-1252."""
    found = [(n, bytes((n,)).decode("cp1252", "ignore")) for n in range(0x80, 0xA0)]
    return F.create_map(*[F.lit(x) for pair in found for x in pair])


def entity_character(entity: Column) -> Column:
    """What an entity stands for; nothing if it stands for no character."""
    body = F.regexp_extract(entity, "^&(?:#x|#)?(.+);$", 1)
    hexed = F.when(body.rlike("^[0-9a-fA-F]{1,6}$"), F.conv(body, 16, 10).cast("int"))
    number = F.when(entity.rlike("^&#x"), hexed).otherwise(F.when(body.rlike(r"^\d{1,8}$"), body.cast("int")))
    legal = ((number > 0) & (number < 0xD800)) | ((number > 0xDFFF) & (number <= 0x10FFFF))
    plain = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    numeric = F.when(number.between(0x80, 0x9F), F.try_element_at(_windows(), number)).when(legal, plain)
    named = F.try_element_at(_named(), body)
    return F.coalesce(F.when(entity.startswith("&#"), numeric).otherwise(named), F.lit(""))


def without_entities(text: Column) -> Column:
    """Named and numeric entities as their characters. Those of the ampersand come last, so that nothing that one
    leaves is read as another."""
    found = F.transform(
        F.array_distinct(F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))),
        lambda e: F.struct((entity_character(e) == "&").alias("last"), e.alias("entity"), entity_character(e).alias("character")),
    )
    decoded = F.aggregate(F.array_sort(found), text, lambda t, e: F.replace(t, e["entity"], e["character"]))
    return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)


def message_tokens(
    text: Column,
    preserve_case: bool = True,
    reduce_length: bool = False,
    strip_handles: bool = False,
    phone_numbers: bool = True,
) -> Column:
    """Tokens in text order; named and numeric entities are read as their characters first."""
    text = without_entities(F.coalesce(text, F.lit("")))
    if strip_handles:
        text = F.regexp_replace(text, HANDLE, " ")
    if reduce_length:
        text = F.regexp_replace(text, r"(.)\1{2,}", "$1$1$1")
    # Long runs of one mark tell no more than three of them.
    text = F.regexp_replace(text, r"([^a-zA-Z0-9])\1{3,}", "$1$1$1")
    kinds = [WEB_ADDRESS] + ([PHONE] if phone_numbers else []) + [EMOTICON] + OTHER
    found = F.regexp_extract_all(text, F.lit("(?iU)" + "|".join(kinds)), F.lit(0))
    if preserve_case:
        return found
    return F.transform(
        found, lambda t: F.when(t.rlike("(?i)" + EMOTICON), t).otherwise(F.lower(t))
    )
