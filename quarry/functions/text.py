"""Column expressions for text: sentences, n-grams, post tokens, entities.

All of these are built-in Spark expressions (regex, ``transform``,
``array_join``), so they run inside whole-stage code generation on the
executors; no Python worker is involved.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference job's behaviour)
# ---------------------------------------------------------------------------
# Paragraph separator of the book source.
PARAGRAPH_SEPARATOR = "\r\n\r\n"
# A sentence ends at a literal ". " (period then one blank); nothing is trimmed.
SENTENCE_SEPARATOR_REGEX = r"\. "
# Words of a normalised sentence: runs of ASCII word characters.
NORMALIZE_WORD_REGEX = r"\w+"
# n-gram words come from splitting at every character outside [0-9a-z].
NGRAM_SPLIT_REGEX = r"[^0-9a-z]"

# Character classes used by the post tokenizer. They are written out so that
# Java regex (Spark) and RE2 (the SQL oracle) agree exactly: Unicode letters,
# numbers and '_' are word characters, Unicode decimal digits are digits and
# white space is what Python's Unicode mode calls white space.
_WS = r"\t-\r\x{1C}-\x{1F}\x{85}\p{Z}"
_W = r"\p{L}\p{N}_"
_D = r"\p{Nd}"
_AZ = "A-Za-z"
# URL body characters: '!', every ASCII character from '$' to '_', a-z.
_URL_BODY = "[!$-_a-z]"
_URL_HEAD = r"[hH][tT][tT][pP][sS]?://"

# Token classes in priority order; at each position the first that matches wins.
TOKEN_CLASSES = (
    # phone number: optional +0/+1 country digit, optional (area) code, 3 + 4 digits
    rf"(?:\+?[01][-.{_WS}]*)?(?:\(?{_D}{{3}}[-.){_WS}]*)?{_D}{{3}}[-.{_WS}]*{_D}{{4}}",
    # http(s) URL
    _URL_HEAD + _URL_BODY + "+",
    # emoticon, eyes first or mouth first, optional nose, optional hat
    r"[<>]?[:;=8][-oO*']?[)\](\[dDpP/:}{@|\\]|[)\](\[dDpP/:}{@|\\][-oO*']?[:;=8][<>]?",
    # markup tag
    r"<[^>]+>",
    # @handle
    rf"@[{_W}]+",
    # #hashtag: starts and ends with a word character
    rf"#+[{_W}][{_W}'\-]*[{_W}]",
    # ASCII word with inner apostrophes, dashes or underscores (3+ chars)
    rf"[{_AZ}][{_AZ}'\-_]+[{_AZ}]",
    # number with one inner , / . : -
    rf"[-+]?{_D}+[,/.:\-]{_D}+[-+]?",
    # plain word
    rf"[{_W}]+",
    # ellipsis of two or more dots, blanks allowed between them
    # (one class and no group: a group would recurse once per dot)
    rf"\.[{_WS}.]*\.",
    # any other single non-blank character
    rf"[^{_WS}]",
)
TOKEN_REGEX = "|".join(f"(?:{c})" for c in TOKEN_CLASSES)
# Tokens containing a match of this pattern keep their case; all others are
# lower-cased. (The reference applies its URL pattern here.)
PRESERVE_CASE_REGEX = _URL_HEAD + _URL_BODY

# Entity handling. Numeric entities are decoded first; then named ones from
# the HTML 4 table (Python's standard ``html.entities``), except "&amp;",
# which becomes " and " only when the text holds some other named entity.
NUMERIC_ENTITY_REGEX = r"&#[0-9]+;"
NAMED_ENTITY_REGEX = r"&[A-Za-z0-9_]+;"
AMP_ENTITY = "&amp;"
AMP_REPLACEMENT = " and "
MAX_CODE_POINT = 0x10FFFF


def named_entity_table() -> dict[str, str]:
    """Entity text (e.g. ``&lt;``) -> character, without ``&amp;``."""
    return {f"&{name};": chr(cp) for name, cp in sorted(name2codepoint.items())
            if name != "amp"}


# ---------------------------------------------------------------------------
# Sentences and n-grams
# ---------------------------------------------------------------------------

def paragraphs(text: Column) -> Column:
    """Array of paragraphs of a text column (the book source's record split)."""
    return F.split(text, PARAGRAPH_SEPARATOR, -1)


def sentences(paragraph: Column) -> Column:
    """Array of sentences: split at every literal ". ", empty pieces kept."""
    return F.split(paragraph, SENTENCE_SEPARATOR_REGEX, -1)


def normalize_sentence(sentence: Column) -> Column:
    """Lower-case, keep runs of ASCII word characters, join with one blank."""
    words = F.regexp_extract_all(F.lower(sentence), F.lit(NORMALIZE_WORD_REGEX), 0)
    return F.array_join(words, " ")


def ngram_words(normalized: Column) -> Column:
    """Words of a normalised sentence (splitting at [^0-9a-z], empties kept)."""
    return F.split(normalized, NGRAM_SPLIT_REGEX, -1)


def ngrams(words: Column, n: Column | int) -> Column:
    """Array of n-grams (words joined by one blank) of consecutive words.

    A sentence shorter than n has none; n-grams never cross sentences. The
    words are split once (``let``), not again for each n-gram.
    """
    n = F.lit(n) if isinstance(n, int) else n

    def windows(w: Column) -> Column:
        count = F.size(w) - n + 1
        return F.when(
            count >= 1,
            F.transform(F.sequence(F.lit(1), count),
                        lambda i: F.array_join(F.slice(w, i, n), " ")),
        ).otherwise(F.array().cast("array<string>"))

    return let(words, windows)


# ---------------------------------------------------------------------------
# Posts: entities and tokens
# ---------------------------------------------------------------------------

def _code_point_to_char(n: Column) -> Column:
    # Four big-endian bytes decoded as UTF-32 give the character of any code point.
    return F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value evaluated once: bound as the variable of a one-element array."""
    return F.get(F.transform(F.array(value), body), 0)


def unescape_entities(text: Column) -> Column:
    """Replace HTML entities with characters, as the reference's tokenizer does."""
    # numeric entities, e.g. "&#8230;"; out-of-range numbers stay as text
    pieces = F.regexp_extract_all(text, F.lit(f"{NUMERIC_ENTITY_REGEX}|&|[^&]+"), 0)

    def decode_numeric(p: Column) -> Column:
        digits = F.regexp_extract(p, r"^&#0*([0-9]+);$", 1)   # any number of leading zeros
        n = F.when(F.length(digits).between(1, 8), digits.cast("bigint"))
        valid = (n.isNotNull() & (n <= MAX_CODE_POINT)
                 & ~n.between(0xD800, 0xDFFF))
        return F.when(valid, _code_point_to_char(n)).otherwise(p)

    numeric = F.array_join(F.transform(pieces, decode_numeric), "")
    numeric = F.when(F.instr(text, "&#") > 0, numeric).otherwise(text)
    return let(numeric, _unescape_named)


def _unescape_named(text: Column) -> Column:
    """Named entities of a text whose numeric ones are decoded.

    They are touched only when the text holds one besides &amp;; then every
    known one becomes its character and every &amp; becomes " and ". Only
    entity pieces are looked up (a literal map is searched key by key).
    """
    table = named_entity_table()
    entity_map = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    others = F.exists(F.regexp_extract_all(text, F.lit(NAMED_ENTITY_REGEX), 0),
                      lambda e: e != F.lit(AMP_ENTITY))
    pieces = F.regexp_extract_all(text, F.lit(f"{NAMED_ENTITY_REGEX}|&|[^&]+"), 0)
    named = F.array_join(F.transform(pieces, lambda p: F.when(
        p.startswith("&") & p.endswith(";") & (p != F.lit(AMP_ENTITY)),
        F.coalesce(F.element_at(entity_map, p), p)).otherwise(p)), "")
    spoken = F.replace(named, F.lit(AMP_ENTITY), F.lit(AMP_REPLACEMENT))
    return F.when((F.instr(text, "&") > 0) & others, spoken).otherwise(text)


def tokenize(text: Column, preserve_case_regex: str | None = PRESERVE_CASE_REGEX) -> Column:
    """Token array of a post text (entities decoded first).

    Tokens are lower-cased unless they contain a match of
    ``preserve_case_regex``; pass ``None`` to lower-case every token.
    """
    tokens = F.regexp_extract_all(unescape_entities(text), F.lit(TOKEN_REGEX), 0)
    if preserve_case_regex is None:
        return F.transform(tokens, F.lower)
    return F.transform(
        tokens, lambda t: F.when(t.rlike(preserve_case_regex), t).otherwise(F.lower(t)))
