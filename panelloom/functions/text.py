"""Text measures as Column expressions.

Everything here stays in the JVM except NFKC and rare HTML entities, which have
no Spark built-in. Those two use Arrow UDFs that receive only the rows needing
them; all other rows pass a null.
"""

from __future__ import annotations

import functools
import html
import os.path
import unicodedata
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values -------------------------------------------------------------
DEFAULT_KEYWORDS = (
    "artificial intelligence",
    "machine learning",
    "deep learning",
    "neural network",
    "generative ai",
    "large language model",
    "natural language processing",
    "computer vision",
)
EXCERPT_CHARS = 500
SLICE_BYTES = 1 << 20  # of texts that are held as Python strings at once
# Density bins: name and the largest mention count still inside it.
DENSITY_BINS = (("zero", 0), ("low", 5), ("medium", 20))
TOP_DENSITY_BIN = "high"
# --------------------------------------------------------------------------

# Under (?U) this is Unicode white space plus the four ASCII separators.
_WS = r"\s\x1c-\x1f"
_WS_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
_WORD = r"\p{L}\p{N}_"

# Entities decoded inside the JVM; "&amp;" comes last so that one pass never decodes twice.
_COMMON_ENTITIES = (
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&apos;", "'"),
    ("&#39;", "'"),
    ("&nbsp;", "\xa0"),
    ("&#160;", "\xa0"),
    ("&copy;", "©"),
    ("&reg;", "®"),
    ("&middot;", "·"),
    ("&ndash;", "–"),
    ("&mdash;", "—"),
    ("&#8211;", "–"),
    ("&#8212;", "—"),
    ("&#8216;", "‘"),
    ("&#8217;", "’"),
    ("&#8220;", "“"),
    ("&#8221;", "”"),
    ("&#8226;", "•"),
    ("&amp;", "&"),
)
_RARE_ENTITY = (
    "&(?!(?:" + "|".join(name[1:-1] for name, _ in _COMMON_ENTITIES) + r");)[^\t\n\f <&;]"
)


# -- white space -------------------------------------------------------------


def strip(text: Column) -> Column:
    """Drop white space of any kind from both ends."""
    return F.btrim(text, F.lit(_WS_CHARS))


def collapse_whitespace(text: Column) -> Column:
    """Every run of white space becomes one space; ends are trimmed."""
    return F.trim(F.regexp_replace(text, rf"(?U)[{_WS}]+", " "))


def token_count(text: Column) -> Column:
    """Number of white-space separated pieces (0 for null).

    Each piece and the space around it shrinks to one character and those are counted:
    a long text never becomes an array with one string per token.
    """
    shrunk = F.regexp_replace(text, rf"(?U)[{_WS}]*+[^{_WS}]++[{_WS}]*+", ".")
    counted = F.when(text.rlike(rf"(?U)[^{_WS}]"), F.char_length(shrunk))
    return F.coalesce(counted, F.lit(0)).cast("bigint")


# -- normalisation -------------------------------------------------------------


@F.arrow_udf(T.StringType())
def _nfkc_batch(text: pa.Array) -> pa.Array:
    """NFKC of a batch, some texts at a time: only those are held as Python strings."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False))
    parts, low = [], 0
    while low < len(text):
        before = sizes[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(sizes, before + SLICE_BYTES, "right")))
        values = text.slice(low, high - low).to_pylist()
        parts.append(
            pa.array([v if v is None else unicodedata.normalize("NFKC", v) for v in values], pa.string())
        )
        low = high
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


def _may_change(code: int) -> bool:
    """Whether a character is no NFKC form by itself, or may move or join with its neighbours."""
    char = chr(code)
    return unicodedata.combining(char) != 0 or unicodedata.normalize("NFKC", char) != char


@functools.cache
def settled_ranges(least: int = 24) -> tuple[tuple[int, int], ...]:
    """Ranges of characters that NFKC leaves alone wherever they stand, the short ones left out.

    Besides characters that change, those that can be the second part of a composition are
    out. All of these lie in the first two planes and one block of the third.
    """
    codes = [*range(0xA0, 0x20000), *range(0x2F800, 0x2FA20)]
    moving = {code for code in codes if _may_change(code)}
    for code in codes:
        parts = unicodedata.decomposition(chr(code)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            moving.add(int(parts[1], 16))
    moving |= {*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)}  # parts of Hangul syllables
    moving |= {*range(0xD800, 0xE000)}  # no characters
    edges = sorted(moving)
    gaps = zip([-1, *edges], [*edges, 0x20000], strict=True)
    return tuple((a + 1, b - 1) for a, b in gaps if b < 0x20001 and b - a - 1 >= least)


def normalize_unicode(text: Column) -> Column:
    """NFKC form. A text of settled characters only is its own NFKC form, and so is every ASCII
    text; those never reach Python. Letters with accents are settled, too, unless the accent
    is a character of its own."""
    ranges = "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in settled_ranges())
    is_ascii = F.octet_length(text) == F.char_length(text)
    settled = is_ascii | ~text.rlike(f"[^{ranges}]")
    return F.when(settled, text).otherwise(_nfkc_batch(F.when(~settled, text)))


def preprocess(text: Column) -> Column:
    """NFKC, then collapsed white space."""
    return collapse_whitespace(normalize_unicode(text))


# -- keywords ------------------------------------------------------------------


def clean_keywords(keywords: Sequence[str]) -> list[str]:
    """Lower-cased, trimmed keywords without blanks."""
    return [kw.strip().lower() for kw in keywords if kw.strip()]


def _quoted(literal: str) -> str:
    return r"\Q" + literal.replace(r"\E", r"\E\\E\Q") + r"\E"


def _first_chars(keywords: Sequence[str]) -> str:
    """A cheap one-character look-ahead that skips hopeless positions."""
    return "(?=[" + "".join(rf"\x{{{ord(c):x}}}" for c in sorted({kw[0] for kw in keywords})) + "])"


def _is_word(char: str) -> bool:
    return char == "_" or char.isalnum()


def keyword_pattern(keywords: Sequence[str]) -> str | None:
    """Whole-word, case-insensitive alternation in list order; None without keywords.

    A word border is spelled out as "next to no letter, digit or underscore", so
    it does not depend on the regex engine's own idea of a word. Keywords that
    start or end with punctuation need a word character beside that end.
    """
    words = clean_keywords(keywords)
    if not words:
        return None
    return "(?iu)" + _first_chars(words) + _alternation(words, borders=True)


def _left(char: str) -> str:
    return rf"(?<![{_WORD}])" if _is_word(char) else rf"(?<=[{_WORD}])"


def _right(char: str) -> str:
    return rf"(?![{_WORD}])" if _is_word(char) else rf"(?=[{_WORD}])"


def _alternation(words: Sequence[str], borders: bool) -> str:
    """One group of all words that matches as trying them in list order does.

    Words of ASCII characters are factored into a trie, so a place in the text is compared
    with each common beginning once, however many words share it. Words whose next characters
    differ can't both match; only a word and its own continuation compete, and there the trie
    keeps the order of the list. Other scripts have characters that match each other without
    being equal, so a list with such words is tried word by word.
    """
    words = list(dict.fromkeys(words))
    ends = {word: _right(word[-1]) if borders else "" for word in words}
    if not all(word.isascii() for word in words):
        parts = [(_left(w[0]) if borders else "") + _quoted(w) + ends[w] for w in words]
        return "(?:" + "|".join(parts) + ")"
    return _trie([(word.lower(), ends[word]) for word in words], borders)


def _trie(entries: list[tuple[str, str]], borders: bool) -> str:
    """Rests of words in list order, each with what must follow it."""
    finished = next((i for i, (rest, _) in enumerate(entries) if not rest), None)
    if finished is not None:
        parts = [_trie(entries[:finished], False)] if finished else []
        parts.append(entries[finished][1])
        later = [entry for entry in entries[finished + 1 :] if entry[0]]
        parts += [_trie(later, False)] if later else []
        return parts[0] if len(parts) == 1 else "(?:" + "|".join(parts) + ")"
    groups: dict[str, list[tuple[str, str]]] = {}
    for rest, end in entries:
        groups.setdefault(rest[0], []).append((rest, end))
    branches = []
    for char, group in groups.items():
        shared = len(os.path.commonprefix([rest for rest, _ in group]))
        beginning = "".join(rf"\x{{{ord(c):x}}}" for c in group[0][0][:shared])
        rests = [(rest[shared:], end) for rest, end in group]
        branches.append((_left(char) if borders else "") + beginning + _trie(rests, False))
    return branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"


def keyword_hits(text: Column, keywords: Sequence[str]) -> Column:
    """All keyword matches, left to right, as they stand in the text."""
    pattern = keyword_pattern(keywords)
    if pattern is None:
        return F.array().cast("array<string>")
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.coalesce(hits, F.array().cast("array<string>"))


def mention_count(text: Column, keywords: Sequence[str]) -> Column:
    """Number of keyword matches."""
    return F.size(keyword_hits(text, keywords)).cast("bigint")


def total_tokens(text: Column, keywords: Sequence[str]) -> Column:
    """Token count, and 0 throughout when no keyword is configured."""
    return token_count(text) if clean_keywords(keywords) else F.lit(0).cast("bigint")


# -- excerpts --------------------------------------------------------------------


def density_bin(count: Column) -> Column:
    """Bin name of a mention count."""
    expr = F.lit(TOP_DENSITY_BIN)
    for name, upper in reversed(DENSITY_BINS):
        expr = F.when(count <= upper, F.lit(name)).otherwise(expr)
    return expr


def head_excerpt(text: Column, length: int = EXCERPT_CHARS) -> Column:
    """The stripped text, cut after ``length`` characters with an ellipsis."""
    body = strip(text)
    cut = F.concat(F.substring(body, 1, length), F.lit("..."))
    return F.when(F.char_length(body) <= length, body).otherwise(cut)


def with_keyword_excerpt(
    df: DataFrame,
    text: str,
    keywords: Sequence[str],
    output: str = "excerpt",
    length: int = EXCERPT_CHARS,
) -> DataFrame:
    """Add a window centred on the first keyword hit, else the head of the text.

    Hits need no word borders here and keywords are taken as given. Offsets come
    from the pieces around the first hit, so they count characters; a regex
    position function would count UTF-16 units. The split is a column of its own
    so that each long text is searched once.
    """
    words = [kw for kw in keywords if kw]
    if not words:
        return df.withColumn(output, head_excerpt(F.col(text), length))
    pattern = "(?iu)" + _first_chars(words) + _alternation(words, borders=False)
    body, size, pieces = F.col("__body"), F.col("__size"), F.col("__pieces")
    df = df.withColumn("__body", strip(F.col(text)))
    df = df.withColumn("__size", F.char_length(body))
    df = df.withColumn("__pieces", F.when(size > length, F.split(body, pattern, 2)))
    df = df.withColumn("__before", F.char_length(F.get(pieces, F.lit(0))))
    hit = size - F.col("__before") - F.char_length(F.get(pieces, F.lit(1)))
    middle = F.col("__before") + F.floor(hit / 2).cast("int")
    df = df.withColumn("__start", F.greatest(middle - length // 2, F.lit(0)))
    start = F.col("__start")
    stop = F.least(start + length, size)
    window = F.concat(
        F.when(start > 0, "...").otherwise(""),
        F.substring(body, start + 1, stop - start),
        F.when(stop < size, "...").otherwise(""),
    )
    head = F.concat(F.substring(body, 1, length), F.lit("..."))
    excerpt = F.when(size <= length, body).when(F.size(pieces) < 2, head).otherwise(window)
    return df.withColumn(output, excerpt).drop(
        "__body", "__size", "__pieces", "__before", "__start"
    )


# -- markup ------------------------------------------------------------------------

# One scan with the alternatives a tokenizer would try at each "<": comment, an
# element whose text is no page text (an unclosed one runs to the end), a ruby
# annotation, whose end tag is optional, or any other tag.
_DROPPED = ("script", "style", "noscript", "template")
HTML_MARKUP = (
    r"(?is)<!--.*?(?:-->|\z)"
    + "".join(rf"|<{tag}\b[^>]*>.*?(?:</{tag}\s*>|\z)" for tag in _DROPPED)
    + r"|<r[tp]\b[^>]*>.*?(?=</?(?:rt|rp|ruby)\b|\z)"
    + r"""|</?[a-z][^'">]*+(?:(?:"[^"]*+"|'[^']*+')[^'">]*+)*+>"""
    + r"|</?[a-z][^>]*>|<[!?/][^>]*>"
)
ANY_TAG = r"<[^>]+>"
_LOOKS_LIKE_HTML = r"(?i)<(?:html|body|div)"


def bytes_to_text(content: Column) -> Column:
    """UTF-8 text, or Latin-1 when the bytes are no valid UTF-8."""
    as_utf8 = content.cast("string")
    return F.when(F.is_valid_utf8(as_utf8), as_utf8).otherwise(F.decode(content, "ISO-8859-1"))


def strip_html(markup: Column) -> Column:
    """Comments, tags and script/style/noscript elements become spaces."""
    return F.regexp_replace(markup, HTML_MARKUP, " ")


def strip_tags(markup: Column) -> Column:
    """Every ``<...>`` becomes a space; element content stays."""
    return F.regexp_replace(markup, ANY_TAG, " ")


@F.pandas_udf(T.StringType())
def _unescape_batch(text: pd.Series, again: pd.Series) -> pd.Series:
    once = text.map(html.unescape, na_action="ignore")
    return once.where(~again, once.map(html.unescape, na_action="ignore"))


def _common_entities(text: Column) -> Column:
    decoded = text
    for entity, char in _COMMON_ENTITIES:
        decoded = F.replace(decoded, F.lit(entity), F.lit(char))
    return F.when(text.rlike("&[#A-Za-z]"), decoded).otherwise(text)


def with_unescaped(df: DataFrame, column: str, again: Column) -> DataFrame:
    """Decode character references in ``column``, and a second time where ``again`` holds.

    Rows made of common entities only are decoded in the JVM. A row with any other
    reference goes to the full HTML5 table in Python. Steps are columns of their
    own, so no row's text is computed again for the UDF input.
    """
    source, once, twice = F.col(column), F.col("__once"), F.col("__again")
    df = df.withColumns({"__once": _common_entities(source), "__again": F.coalesce(again, F.lit(False))})
    rare = source.rlike(_RARE_ENTITY) | (twice & once.rlike(_RARE_ENTITY))
    df = df.withColumn("__rare", F.coalesce(rare, F.lit(False)))
    common = F.when(twice, _common_entities(once)).otherwise(once)
    full = _unescape_batch(F.when(F.col("__rare"), source), twice)
    decoded = F.when(F.col("__rare"), full).otherwise(common)
    return df.withColumn(column, decoded).drop("__once", "__again", "__rare")


def with_html_text(df: DataFrame, markup: str, output: str = "text") -> DataFrame:
    """HTML to text: markup out, references decoded twice, white space collapsed."""
    df = with_unescaped(df.withColumn(output, strip_html(F.col(markup))), output, F.lit(True))
    return df.withColumn(output, collapse_whitespace(F.col(output)))


def with_stripped_text(df: DataFrame, markup: str, output: str = "text") -> DataFrame:
    """Fast form: tags out, references decoded once, white space collapsed."""
    df = with_unescaped(df.withColumn(output, strip_tags(F.col(markup))), output, F.lit(False))
    return df.withColumn(output, collapse_whitespace(F.col(output)))


def with_filing_text(df: DataFrame, content: str, output: str = "text") -> DataFrame:
    """Raw bytes to text: HTML route for files that look like HTML, else the fast one.

    The route depends on the content only, so a page's text does not change with its size.
    """
    df = df.withColumn("__raw", bytes_to_text(F.col(content)))
    df = df.withColumn("__html", F.col("__raw").rlike(_LOOKS_LIKE_HTML))
    stripped = F.when(F.col("__html"), strip_html(F.col("__raw"))).otherwise(
        strip_tags(F.col("__raw"))
    )
    df = with_unescaped(df.withColumn(output, stripped), output, F.col("__html"))
    return df.withColumn(output, collapse_whitespace(F.col(output))).drop("__raw", "__html")
