"""Splitting of markup-laden field text into pieces, keys and values.

All functions take and return Columns made of built-in expressions, so the same call works on a
table column, on the element of an exploded array and inside a higher-order function.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: every character that Unicode counts as white space (no-break space included)
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
# the same set for patterns: control characters and all Unicode separators
_CONTROLS = r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85"
_SPACES = _CONTROLS + r"\p{Z}"
_ODD_SPACES = _CONTROLS + r"[\p{Z}&&[^ ]]"
_WS = f"[{_SPACES}]"

# fixed values: the markup the source data uses
BREAK = f"(?i)<br{_WS}*/?>"
STRONG_PAIR = "(?id)<strong>.*?</strong>"
STRONG_OPEN = f"(?is)<strong(?:{_WS}[^>]*)?>"
STRONG_CLOSE = f"(?is)</strong{_WS}*>"
NOTE_PLAIN = "(?i)<b>note:</b>"
NOTE_TAG = f"(?is)<b(?:{_WS}[^>]*)?>[^<]*note:[^<]*</b>"

SIMPLE = "simple"
KEY_WITH_SUB_VALUES = "key_with_sub_values"
KEY_VALUE_PAIRS = "key_value_pairs"
KEY_VALUE_PAIRS_WITH_NOTES = "key_value_pairs_with_notes"
STRUCTURE_TYPES = (SIMPLE, KEY_WITH_SUB_VALUES, KEY_VALUE_PAIRS, KEY_VALUE_PAIRS_WITH_NOTES)

# A break with all white space and further breaks behind it; the loop is possessive, so it neither
# backtracks nor recurses.
_BREAK_RUN = f"(?i)<br{_WS}*/?>(?:{_WS}|<br{_WS}*/?>)*+"


def _text(data: Column) -> Column:
    return F.coalesce(data, F.lit(""))


def strip(text: Column) -> Column:
    """Remove Unicode white space at both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def strip_end(text: Column) -> Column:
    """Remove Unicode white space at the end; pass a named column."""
    # trimming by a set of characters looks at the whole text; most texts end with a visible ASCII character
    last = F.ascii(F.substring(text, -1, 1))
    return F.when((last > 32) & (last < 127), text).otherwise(F.rtrim(text, F.lit(WHITESPACE)))


def _split(text: Column, pattern: str, plain: str) -> Column:
    """Split on ``pattern``.

    ``split`` compiles its pattern for every row, ``regexp_replace`` keeps it compiled; so every
    match first becomes ``plain``, one of the strings that match, and that is cheap to split on.
    """
    return F.split(F.regexp_replace(text, pattern, plain), plain, -1)


def _before(text: Column, pattern: str) -> Column:
    """Text before the first match, all of it without one."""
    return F.regexp_replace(text, f"{pattern}.*$", "")


def _behind(text: Column, pattern: str) -> Column:
    """Text behind the first match, empty without one."""
    return F.regexp_extract(text, f"{pattern}(.*)$", 1)


def strip_colons(text: Column) -> Column:
    """Remove all trailing colons, then white space."""
    return F.rtrim(F.rtrim(strip(text), F.lit(":")), F.lit(WHITESPACE))


# a single plain space between words needs no replacement, so neither pattern matches it
_SPACE_RUN = f"(?: {_WS}|[{_ODD_SPACES}]){_WS}*+"
_BREAK_OR_SPACE_RUN = (
    f"(?i)(?: (?:{_WS}|<br{_WS}*/?>)|[{_ODD_SPACES}]|<br{_WS}*/?>)(?:{_WS}|<br{_WS}*/?>)*+"
)


def collapse_whitespace(text: Column) -> Column:
    """Turn every run of white space into one space and strip the ends."""
    # only plain spaces are left, and those are trimmed at far less cost
    return F.trim(F.regexp_replace(text, _SPACE_RUN, " "))


def flat_text(html: Column) -> Column:
    """``collapse_whitespace`` with breaks counting as white space."""
    return F.trim(F.regexp_replace(html, _BREAK_OR_SPACE_RUN, " "))


def strip_tags(html: Column) -> Column:
    return F.regexp_replace(html, "<[^>]*>", "")


def decode_entities(text: Column) -> Column:
    """Decode the five XML entities and ``&nbsp;``; ``&amp;`` goes last so nothing decodes twice.

    ``markup.decode_references`` knows all of HTML.
    """
    # fixed values
    for entity, char in (
        ("&nbsp;", " "),
        ("&lt;", "<"),
        ("&gt;", ">"),
        ("&quot;", '"'),
        ("&apos;", "'"),
        ("&amp;", "&"),
    ):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def break_parts(data: Column) -> Column:
    """Non-blank parts between break tags, with their trailing white space still on.

    Cheaper than ``split_values`` when the array is exploded anyway: use ``strip_end`` on the rows.
    """
    return F.array_remove(_split(strip(_text(data)), _BREAK_RUN, "<br>"), "")


def split_values(data: Column) -> Column:
    """Parts between break tags, stripped, blanks dropped; empty array for null."""
    return F.transform(break_parts(data), strip_end)


def has_breaks(data: Column) -> Column:
    """True when the text holds at least one break tag."""
    return F.coalesce(data.rlike(BREAK), F.lit(False))


def strong_count(data: Column) -> Column:
    """Number of plain ``<strong>…</strong>`` pairs; name this column before reusing it."""
    return F.regexp_count(_text(data), F.lit(STRONG_PAIR))


def structure_type(data: Column, strongs: Column | None = None) -> Column:
    """One of ``STRUCTURE_TYPES``; pass a named ``strongs`` column to count the tags only once."""
    n = strong_count(data) if strongs is None else strongs
    return (
        F.when(n == 0, SIMPLE)
        .when(n == 1, KEY_WITH_SUB_VALUES)
        .when(data.rlike(NOTE_PLAIN), KEY_VALUE_PAIRS_WITH_NOTES)
        .otherwise(KEY_VALUE_PAIRS)
    )


def is_multi_valued(kind: Column, n_values: Column, notes_multi_valued: bool = False) -> Column:
    """Flag by structure type; pairs with notes count as single unless asked otherwise."""
    flag = F.when(kind == KEY_VALUE_PAIRS, True).when(kind == SIMPLE, n_values > 1)
    if notes_multi_valued:
        flag = flag.when(kind == KEY_VALUE_PAIRS_WITH_NOTES, n_values > 1)
    return flag.otherwise(False)


def _drop_first(pieces: Column) -> Column:
    return F.filter(pieces, lambda _, i: i > 0)


def strong_segments(data: Column) -> Column:
    """The text behind each strong tag, up to the next one; text before the first is dropped."""
    return _drop_first(_split(_text(data), STRONG_OPEN, "<strong>"))


def note_segments(data: Column) -> Column:
    """The text behind each note tag."""
    return _drop_first(_split(_text(data), NOTE_TAG, "<b>note:</b>"))


def key_html(segment: Column) -> Column:
    """The inside of the strong tag that opens ``segment``."""
    return _before(segment, STRONG_CLOSE)


def key_text(html: Column) -> Column:
    """Text of a key without markup and trailing colons; pass a named column."""
    return strip_colons(F.when(F.contains(html, F.lit("<")), strip_tags(html)).otherwise(html))


def pair_content(segment: Column) -> Column:
    """What follows the strong tag that opens ``segment``."""
    return _behind(segment, STRONG_CLOSE)


def note_content(segment: Column) -> Column:
    """What follows a note tag, up to the next strong tag."""
    return _before(segment, STRONG_OPEN)


def before_note(html: Column) -> Column:
    return _before(html, NOTE_TAG)


def first_pair(data: Column) -> Column:
    """Key HTML and content of the first strong tag of text without nested elements."""
    behind = _behind(_text(data), STRONG_OPEN)
    return F.struct(key_html(behind).alias("k"), pair_content(behind).alias("c"), F.lit(0).alias("i"))
