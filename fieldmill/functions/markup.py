"""Keyed text in any nesting: what stands behind a strong or note tag within the element around it.

Most keyed text is flat: no element holds another one.  There the text between two strong tags is the
answer and ``is_flat`` tells so with one linear pattern.  Text whose elements all close, nested to a depth
that one pattern can follow, is read by patterns as well.  In other text end tags that close nothing are
dropped and elements that are still open where their parent closes end there; so mended, it is read the same
way.  What patterns can't follow (deeper text, a strong tag in another one, comments, scripts, quoted angle
brackets) is cut into tokens, and one pass over them carries the stack of open elements: it gives the same
contents for any text, at several times the cost.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: elements without an end tag, and those whose content is no markup
VOID = (
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen link menuitem "
    "meta nextid param source spacer track wbr"
).split()
RAW = ("script", "style")

_NAME = r"[A-Za-z][^\s/>]*+"
_REST = r"(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?>"
_ANY = rf"<!--.*?-->|<![^>]*>|<(?<raw>{'|'.join(RAW)})\b[^>]*>.*?</\k<raw>\s*>|</?{_NAME}{_REST}|[^<]++|<"
_TOKEN = f"(?is){_ANY}"
_FLAT = rf"(?is)^(?:[^<]++|<br\s*+/?>|<(?!br[\s/>])({_NAME})(?:\s[^>/]*+)?>[^<]*+</\1\s*+>)*+$"

_STACK = "array<struct<name:string,at:int>>"
_MARKS = "array<struct<name:string,open:int,close:int,parent:int,ends:int,tail:string>>"
_FIXES = "array<struct<at:int,text:string>>"
_STATE = f"struct<stack:{_STACK},marks:{_MARKS},fixes:{_FIXES}>"

# The walk is one long expression.  It is written as SQL text, which the session parses in one go; built
# call by call it would take seconds to put together.


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _listed(words) -> str:
    return ", ".join(map(_literal, words))


def _let(name: str, value: str, body: str) -> str:
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _apply(function: str, value: Column) -> Column:
    """``function``, the text of a lambda, called with ``value``."""
    return F.get(F.call_function("transform", F.array(value), F.expr(function)), F.lit(0))


def is_flat(html: Column) -> Column:
    """True where every element holds only text, breaks apart; then no stack is needed."""
    return html.rlike(_FLAT)


def _tokens(html: str) -> str:
    """``array<struct<text, at, name, kind>>`` in order; kinds are text, open, close and alone."""
    token = f"""named_struct(
      'text', if(startswith(x, '<!'), '', x), 'at', i, 'name', n, 'kind',
      CASE WHEN n = '' OR (n IN ({_listed(RAW)}) AND contains(x, '</') AND endswith(x, '>')) THEN 'text'
        WHEN startswith(x, '</') THEN 'close'
        WHEN n IN ({_listed(VOID)}) OR endswith(x, '/>') THEN 'alone' ELSE 'open' END)"""
    name = f"lower(regexp_extract(x, {_literal(f'^</?({_NAME})')}, 1))"
    return f"transform(regexp_extract_all({html}, {_literal(_TOKEN)}, 0), (x, i) -> {_let('n', name, token)})"


def _end_tags(stack: str, above: str) -> str:
    """End tags of the elements above position ``above`` (from 0) of the stack, the top first."""
    inner = f"reverse(slice({stack}, {above} + 2, size({stack})))"
    return f"array_join(transform({inner}, e -> '</' || e.name || '>'), '')"


def _closed(state: str, lowest: str, at: str) -> str:
    """The marks when the elements from position ``lowest`` of the stack on close at token ``at``."""
    parent = f"CAST(array_position({state}.stack.at, m.parent) AS INT) - 1"
    own = f"m.close IS NULL AND array_position({state}.stack.at, m.open) - 1 >= {lowest}"
    mark = f"""named_struct(
      'name', m.name, 'open', m.open, 'close', if({own}, {at}, m.close), 'parent', m.parent,
      'ends', if(m.ends IS NULL AND p >= {lowest}, {at}, m.ends),
      'tail', if(m.close IS NOT NULL AND m.ends IS NULL AND p >= {lowest}, {_end_tags(f"{state}.stack", "p")},
        m.tail))"""
    return f"transform({state}.marks, m -> {_let('p', parent, mark)})"


def _step() -> str:
    """The state ``s`` behind token ``t``; position 0 of the stack is the text itself, opened at -1."""

    def state(stack: str, marks: str, fixes: str) -> str:
        return f"CAST(named_struct('stack', {stack}, 'marks', {marks}, 'fixes', {fixes}) AS {_STATE})"

    mark = """array(named_struct('name', t.name, 'open', t.at, 'close', CAST(NULL AS INT),
      'parent', element_at(s.stack, -1).at, 'ends', CAST(NULL AS INT), 'tail', ''))"""
    opened = state(
        "concat(s.stack, array(named_struct('name', t.name, 'at', t.at)))",
        f"if(t.name IN ('strong', 'b'), concat(s.marks, {mark}), s.marks)",
        "s.fixes",
    )
    # the last open element of this name
    last = "array_max(transform(s.stack, (e, k) -> if(e.name = t.name AND k > 0, k, NULL)))"
    inside = f"{_end_tags('s.stack', 'k')} || t.text"
    closed = state(
        "slice(s.stack, 1, k)",
        _closed("s", "k", "t.at"),
        f"if(k < size(s.stack) - 1, concat(s.fixes, array(named_struct('at', t.at, 'text', {inside}))), s.fixes)",
    )
    stray = state("s.stack", "s.marks", "concat(s.fixes, array(named_struct('at', t.at, 'text', '')))")
    close = _let("k", last, f"if(k IS NULL, {stray}, {closed})")
    return f"(s, t) -> CASE t.kind WHEN 'open' THEN {opened} WHEN 'close' THEN {close} ELSE s END"


def _between(tokens: str, after: str, before: str) -> str:
    return f"slice({tokens}, {after} + 2, greatest({before} - {after} - 1, 0))"


def _joined(tokens: str) -> str:
    return f"array_join({tokens}.text, '')"


def _content(mark: str, stops: str) -> str:
    """What follows ``mark`` in its parent, up to the first of ``stops`` that is its sibling."""
    behind = f"filter({stops}, y -> y.parent = {mark}.parent AND y.open > {mark}.open)"
    to_stop = _joined(_between("w.tokens", f"{mark}.close", "stop"))
    to_end = _joined(_between("w.tokens", f"{mark}.close", f"{mark}.ends"))
    return _let("stop", f"array_min({behind}.open)", f"if(stop IS NULL, {to_end} || {mark}.tail, {to_stop})")


def _nested() -> str:
    start = f"CAST(named_struct('stack', array(named_struct('name', '', 'at', -1)), 'marks', array(), 'fixes', array()) AS {_STATE})"
    mended = _let(
        "fixes",
        "map_from_entries(s.fixes)",
        "transform(tokens, t -> named_struct('text', coalesce(fixes[t.at], t.text), 'at', t.at, 'name', t.name,"
        " 'kind', t.kind))",
    )
    # a note tag holds one run of text; end tags in it that close nothing may stand at its ends
    inner = _between("tokens", "m.open", "m.close")
    is_note = _let(
        "texts",
        f"filter({inner}, t -> t.kind = 'text')",
        f"forall({inner}, t -> t.kind IN ('text', 'close')) AND contains(lower({_joined('texts')}), 'note:')"
        " AND texts[size(texts) - 1].at - texts[0].at = size(texts) - 1",
    )
    found = f"""named_struct(
      'tokens', if(size(s.fixes) > 0, {mended}, tokens),
      'strongs', filter(marks, m -> m.name = 'strong'),
      'notes', filter(marks, m -> m.name = 'b' AND {is_note}))"""
    pairs = f"""transform(w.strongs, (x, i) -> named_struct(
      'k', {_joined(_between("w.tokens", "x.open", "x.close"))},
      'c', {_content("x", "concat(slice(w.strongs, i + 2, 1), if(a.noted, w.notes, slice(w.notes, 1, 0)))")},
      'i', i))"""
    notes = f"""transform(if(a.noted, w.notes, slice(w.notes, 1, 0)), (x, i) -> named_struct(
      'k', 'note', 'c', {_content("x", "concat(w.strongs, w.notes)")}, 'i', i + size(w.strongs)))"""
    walked = _let("marks", _closed("s", "0", "size(tokens)"), found)
    body = _let("w", walked, f"concat({pairs}, {notes})")
    walk = _let("s", f"aggregate(tokens, {start}, {_step()})", body)
    return _let("tokens", _tokens("a.html"), walk)


# ---- text that patterns can follow -----------------------------------------------------------------

# fixed value: how deep elements may lie in each other for the patterns; deeper text is walked
DEPTH = 6

_PLAIN_TEXT = r"[^<]++|<(?![A-Za-z/!])"
_PLAIN_NAME = r"[A-Za-z][A-Za-z0-9]*+"
_QUOTED = r"(?:[\s/](?:[^<>\"']++|\"[^\"<>]*+\"|'[^'<>]*+')*+)?+"
_OPEN_END, _ALONE_END = r"(?<!/)>", r"(?<=/)>"


def _item(depth: int, level: str, strongs: bool = True) -> str:
    """A pattern for text, a tag that stands alone or a whole element with ``depth`` others in each other in it.

    Group names start with ``level``.  Without ``strongs`` no strong element may be in it.
    """
    not_raw = f"(?!(?:{'|'.join(RAW)})[\\s/>])"
    by_letter = {a: "|".join(name[1:] for name in VOID if name[0] == a) for a in sorted({name[0] for name in VOID})}
    void = f"(?:{'|'.join(f'{a}(?:{rest})' for a, rest in by_letter.items())})(?=[\\s/>])"
    alone = f"{void}{_QUOTED}>|{_PLAIN_NAME}{_QUOTED}{_ALONE_END}"
    if depth < 0:
        return f"{_PLAIN_TEXT}|<(?=[a-z]){not_raw}(?:{alone})"
    no_strong = "" if strongs else r"(?!strong[\s>])"
    inner = _item(depth - 1, level, strongs)
    name = f"{level}{depth}"
    element = f"{no_strong}(?!{void})(?<{name}>{_PLAIN_NAME}){_QUOTED}{_OPEN_END}(?:{inner})*+</\\k<{name}>\\s*+>"
    return f"{_PLAIN_TEXT}|<(?=[a-z]){not_raw}(?:{element}|{alone})"


_ITEM, _NO_STRONG_ITEM = _item(DEPTH - 1, "e"), _item(DEPTH - 1, "n", strongs=False)
_REGULAR = rf"(?is)\A(?:{_ITEM})*+\z"
_STRONG_START = rf"<strong(?=[\s/>]){_QUOTED}{_OPEN_END}"
_STRONG_IN_STRONG = rf"(?is){_STRONG_START}(?:[^<]++|<(?!/?strong[\s/>]))*+<strong[\s/>]"
_KEY = rf"{_STRONG_START}((?:[^<]++|<(?!/strong\s*+>))*+)</strong\s*+>"
_NOTE_CHAR = r"(?:[^<]|<(?![A-Za-z/!]))"
_NOTE = rf"<b(?=[\s/>]){_QUOTED}{_OPEN_END}(?:(?!note:){_NOTE_CHAR})*+note:{_NOTE_CHAR}*+</b\s*+>"


def _pair_pattern(stop: str) -> str:
    """Group 1 is what follows a strong element: up to the next one, if that is its sibling, or ``stop``."""
    to_strong = f"(?:{stop}(?:{_NO_STRONG_ITEM}))*+(?={_STRONG_START})"
    key = _KEY.replace("((?:", "(?:(?:")
    return f"(?is){key}(?=({to_strong}|(?:{stop}(?:{_ITEM}))*+))"


_PAIR, _NOTED_PAIR = _pair_pattern(""), _pair_pattern(f"(?!{_NOTE})")
_NOTE_PAIR = f"(?is){_NOTE}(?=((?:(?!{_NOTE}|{_STRONG_START})(?:{_ITEM}))*+))"

# two characters mark the pieces of text to be mended: one before each, one behind whole items and before tags
_PIECE, _TAG = "\x01", "\x02"
_PIECES = f"(?is)((?:{_ITEM})++)|(?<tag>{_ANY})"
_MARKED = f"{_PIECE}$1{_TAG}${DEPTH + 2}"


def _mended(html: str) -> str:
    """``html`` with all its elements closed and without other end tags; null where the walk has to read it.

    The state holds the end tags of the open elements, the innermost first, and the text so far.
    """

    def state(stack: str, out: str) -> str:
        return f"named_struct('stack', {stack}, 'out', {out})"

    unknown = state("s.stack", "CAST(NULL AS STRING)")
    # a bracket at the end could open a tag with what comes then; a dropped tag parts the text of a note
    bracket = f"endswith(s.out, '<{_TAG}')"
    closed = state(
        "substring(s.stack, k + length(n) + 3)",
        f"if({bracket}, NULL, s.out || substring(s.stack, 1, k - 1) || p)",
    )
    stray = state("s.stack", f"if({bracket} OR startswith(s.stack, '</b>'), NULL, s.out)")
    close = _let("k", "instr(s.stack, '</' || n || '>')", f"if(k = 0, {stray}, {closed})")
    tag = f"""CASE WHEN n = '' OR n IN ({_listed(RAW)}) THEN {unknown}
      WHEN startswith(p, '{_TAG}</') THEN {close}
      WHEN endswith(p, '/>') OR n IN ({_listed(VOID)}) THEN {unknown}
      ELSE {state("'</' || n || '>' || s.stack", "s.out || p")} END"""
    name = f"lower(regexp_extract(p, {_literal(f'^{_TAG}</?({_NAME})')}, 1))"
    step = f"""(s, p) -> if(startswith(p, '{_TAG}'), {_let("n", name, tag)}, {state("s.stack", "s.out || p")})"""
    pieces = f"split(regexp_replace({html}, {_literal(_PIECES)}, '{_MARKED}'), '{_PIECE}')"
    start = state("''", f"if({html} RLIKE '[{_PIECE}{_TAG}]', NULL, '')")
    whole = f"if({bracket} AND s.stack <> '', NULL, replace(s.out || s.stack, '{_TAG}', ''))"
    return f"aggregate({pieces}, {start}, {step}, s -> {whole})"


def _read(html: str, noted: str) -> str:
    """Pairs and notes of regular text without a strong tag in another one."""

    def all_of(pattern: str) -> str:
        return f"regexp_extract_all({html}, {_literal(pattern)}, 1)"

    contents = f"if({noted}, {all_of(_NOTED_PAIR)}, {all_of(_PAIR)})"
    pairs = "transform(ks, (k, i) -> named_struct('k', k, 'c', get(cs, i), 'i', i))"
    notes = f"""if({noted}, transform({all_of(_NOTE_PAIR)}, (c, i) -> named_struct(
      'k', 'note', 'c', c, 'i', i + size(ks))), array())"""
    return _let("ks", all_of(f"(?is){_KEY}"), _let("cs", contents, f"concat({pairs}, {notes})"))


def _contents() -> str:
    def regular(html: str) -> str:
        return f"{html} RLIKE {_literal(_REGULAR)}"

    readable = _let("m", _mended("a.html"), f"if({regular('m')}, m, NULL)")
    whole = f"if({regular('a.html')}, a.html, {readable})"
    walked = f"if(h IS NULL OR h RLIKE {_literal(_STRONG_IN_STRONG)}, {_nested()}, {_read('h', 'a.noted')})"
    return f"a -> {_let('h', whole, walked)}"


_CONTENTS, _WALKED = _contents(), f"a -> {_nested()}"


def nested_contents(html: Column, noted: Column) -> Column:
    """``array<struct<k, c, i>>`` of text that isn't flat: key HTML, content, order.

    A pair's content ends at the strong tag after it, if that is its sibling, and at the end of its parent;
    a pair inside a later sibling so belongs to both.  Where the text is ``noted``, a note beside a pair ends
    it as well, and notes follow the pairs.
    """
    return _apply(_CONTENTS, F.struct(html.alias("html"), noted.alias("noted")))


def walked_contents(html: Column, noted: Column) -> Column:
    """``nested_contents`` by the walk over all tokens alone."""
    return _apply(_WALKED, F.struct(html.alias("html"), noted.alias("noted")))


# ---- character references ------------------------------------------------------------------------

_REFERENCE = "&(?:#[0-9]++|#[xX][0-9a-fA-F]++|[A-Za-z][A-Za-z0-9]*+);?"
# fixed values: by far the most frequent names, looked up before the others
_FREQUENT = {"amp": "&", "nbsp": "\u00a0", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}


def _map_literal(entries: dict[str, str]) -> str:
    """A map that is one constant of the plan, not two for each entry."""
    return f"from_json({_literal(json.dumps(entries))}, 'map<string,string>')"


def _decoded(reference: str) -> str:
    """The text of a reference; an unknown name stays as written."""
    names = {known.removesuffix(";"): text for known, text in html5.items()}
    frequent = " ".join(f"WHEN {_literal(n)} THEN {_literal(t)}" for n, t in _FREQUENT.items())
    named = f"CASE n {frequent} ELSE {_map_literal(names)}[n] END"
    by_name = f"""coalesce({_let("n", f"regexp_replace({reference}, '^&|;$', '')", named)}, {reference})"""
    # of a longer number the first nine digits are beyond any code point already
    digits = f"substring(ltrim('0', regexp_replace({reference}, '^&#[xX]?|;$', '')), 1, 9)"
    number = f"if({reference} RLIKE '^&#[xX]', conv({digits}, 16, 10), {digits})"
    odd = {str(n): bytes([n]).decode("cp1252", "replace") for n in range(0x80, 0xA0)}
    character = f"""CASE WHEN c BETWEEN 128 AND 159 THEN {_map_literal(odd)}[CAST(c AS STRING)]
      ELSE decode(unhex(lpad(hex(if(c = 0 OR c > 1114111 OR c BETWEEN 55296 AND 57343, 65533, c)), 8, '0')),
        'UTF-32') END"""
    by_number = _let("c", f"coalesce(try_cast({number} AS BIGINT), 0)", character)
    return f"if(startswith({reference}, '&#'), {by_number}, {by_name})"


def _decode(text: str, keep_markup: bool) -> str:
    decoded = _decoded("r")
    if keep_markup:
        decoded = _let("d", decoded, "if(d IN ('&', '<', '>'), r, d)")
    pieces = f"regexp_extract_all({text}, {_literal(f'{_REFERENCE}|[^&]++|&')}, 0)"
    piece = f"if(startswith(r, '&') AND length(r) > 1, {decoded}, r)"
    return f"if(contains({text}, '&'), array_join(transform({pieces}, r -> {piece}), ''), {text})"


_DECODE = f"x -> {_decode('x', keep_markup=False)}"
_DECODE_VALUE = f"""v -> aggregate({_tokens("v")}, named_struct('depth', 0, 'text', ''), (s, t) -> named_struct(
  'depth', s.depth + CASE t.kind WHEN 'open' THEN 1 WHEN 'close' THEN -1 ELSE 0 END,
  'text', s.text || CASE WHEN t.kind <> 'text' OR startswith(t.text, '<') THEN t.text
    WHEN s.depth = 0 THEN {_decode("t.text", keep_markup=False)} ELSE {_decode("t.text", keep_markup=True)} END),
  s -> s.text)"""


def decode_references(text: Column) -> Column:
    """Every character reference of HTML decoded once: named, decimal or hexadecimal.

    The semicolon may lack where the name or number ends.  Numbers 128 to 159 are read as windows-1252;
    numbers without a character become U+FFFD; unknown names stay.
    """
    return _apply(_DECODE, text)


def decode_value(html: Column) -> Column:
    """``decode_references`` for a value that may hold elements.

    Inside them a reference to ``&``, ``<`` or ``>`` stays, so that the element reads the same as before;
    tags stay as they are.
    """
    marked = F.contains(html, F.lit("<"))
    return (
        F.when(~F.contains(html, F.lit("&")), html)
        .when(marked, _apply(_DECODE_VALUE, html))
        .otherwise(decode_references(html))
    )
