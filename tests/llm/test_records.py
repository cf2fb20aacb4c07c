"""Archives, conversations, page texts and mixing."""

import hashlib
import json
from collections import Counter
from fractions import Fraction
from itertools import islice

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import fieldmill.llm.chat as C
import fieldmill.llm.mixing as M
import fieldmill.llm.warc as W
from fieldmill.llm.html_text import extract, main_text
from fieldmill.llm.queries import op4_chat
from fieldmill.llm.tables import table

# ---- archives -------------------------------------------------------------------------------------------


def archived(rows):
    best = {}
    for i, html in rows:
        data = (html or "").encode()
        if len(data) >= 1000:
            key = hashlib.sha1(data).hexdigest()
            best[key] = max(best.get(key, -1), -1 if i is None else i)
    out = []
    for i, html in rows:
        data = (html or "").encode()
        digest = hashlib.sha1(data).hexdigest()
        again = digest in best and best[digest] != i
        out.append((i, len(data), digest, "revisit" if again else "response", best[digest] if again else None))
    return sorted(out, key=str)


def through(frame, tmp_path):
    got = W.through_archives(frame, str(tmp_path / "archives")).collect()
    return sorted((tuple(r[:5]) for r in got), key=str)


def test_pages_through_archives(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "FILE_BYTES", 20_000)  # several files, so both ARC versions
    pages = table(spark, sf_dir, "pages")
    assert through(pages, tmp_path) == archived([(r.page_id, r.html) for r in pages.collect()])


def test_odd_pages_through_archives(spark, tmp_path):
    long = "ü" * 700
    rows = [
        (1, "http://a/b c", long), (2, None, long), (9, "x", long), (3, "", None), (4, "u", ""),
        (5, "u", "a" * 1000), (6, "u", "a" * 999), (7, "u", "a" * 999), (8, "u", "WARC/1.0\r\n\r\n\r\nHTTP/1.1 200\n\n"),
        (-3, "u", "filedesc://x 0 0 0 5\n"), (10, "u", "z\r\n\r\n" * 300),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = pages.selectExpr("*", "'x' AS record_id")
    assert through(pages, tmp_path / "a") == archived([(i, h) for i, _, h in rows])
    assert through(pages.limit(0), tmp_path / "b") == []
    twice = through(pages.where("page_id = 9").union(pages.where("page_id = 9")), tmp_path / "c")
    assert Counter(r[3] for r in twice) == {"response": 1, "revisit": 1}


def test_arc_versions_and_broken_records():
    v1 = b"filedesc://a 0.0.0.0 20010203040506 text/plain 75\n" + (
        b"1 0 x\n" + W.ARC_FIELDS[1].encode() + b"\n"
    ).ljust(75, b"\n")
    v1 += b"http://h/a b 1.2.3.4 20010203 text/html 5\nhello\nnonsense\nhttp://h/c 1.2.3.4 2001 text/html 99\ncut"
    got = list(W.arc_records(v1))
    assert [(r["URL"], r["block"]) for r in got] == [("http://h/a b", b"hello"), ("http://h/c", b"cut")]
    block = b"2 0 x\n" + W.ARC_FIELDS[2].encode() + b"\n"
    v2 = b"filedesc://a 0 2001 text/plain 200 - - 0 a %d\n" % len(block) + block
    v2 += b"http://h/ 1.2.3.4 20010203040506 text/html 404 - - 9 a 3\nabc\n"
    (r,) = W.arc_records(v2)
    assert (r["Result-code"], r["Offset"], r["block"]) == ("404", "9", b"abc")
    assert W._warc_date("20010203") == "2001-02-03T00:00:00Z"


# ---- conversations ------------------------------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def test_conversations_read_back(spark, sf_dir):
    turns = {}
    for r in table(spark, sf_dir, "conversations").collect():
        turns.setdefault(r.conv_id, []).append((r.turn, r.role, r.text or ""))
    said = "</s>[INST] ok [/INST]"
    turns[-7] = [(0, "user", said), (1, "assistant", said)]
    got = {r.conv_id: r for r in op4_chat(spark, sf_dir).collect()}
    assert set(got) == set(turns)
    for i, own in turns.items():
        own.sort()
        learned = "".join(t for _, role, t in own if role == "assistant")
        whole = "".join(f"{role}\n{t}\n" for _, role, t in own)
        r = got[i]
        assert (r.n_turns, r.turns_sha256) == (len(own), sha(whole))
        assert (r.loss_chars, r.loss_sha256) == (len(learned), sha(learned))
    assert {"prompt", "conversations"} <= {r.layout for r in got.values()}


pieces = st.sampled_from(
    ["<", "[", "\\", "|", "s>", "/s>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<|im_start|>",
     "<|im_end|>\n", "user\n", "a", "é", "\n", "<\\/s>", "<start_of_turn>", "im_end|>"]
)
texts = st.lists(pieces, max_size=12).map("".join)
roles = st.one_of(st.sampled_from(["user", "assistant", "system"]), texts)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(roles, texts), max_size=5))
def test_any_turns_read_back(turns):
    text, spans = C.formatted(turns)
    assert C.read_back(text) == turns
    assert [C.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
    for _, said in turns:
        assert not any(c in C.escape(said) for c in ("<|im_start|>", "<|im_end|>", "</s>", "[INST]", "<<SYS>>"))


def test_layouts_by_fingerprint(spark):
    records = [
        {"messages": [{"role": "user", "content": "q"}, {"content": "a", "role": "assistant"}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"dialog": {"turns": [{"speaker": "user", "utterance": "q"}, {"speaker": "assistant", "utterance": "a"}]}},
        {"prompt": "q", "response": "a"},
        {"completion": "a", "prompt": "q"},
        {"instruction": "q", "output": "a"},
        {"data": {"question": "q", "answer": "a"}},
    ]
    odd = ['{"other": 1}', "not json", None, '{"messages": 5}', '{"messages": []}', "[]", '{"prompt": null, "response": {"x": 1}}']
    rows = [(i, json.dumps(r)) for i, r in enumerate(records)] + [(100 + i, r) for i, r in enumerate(odd)]
    rows.append((50, json.dumps({"instruction": "i", "input": "x", "output": "o", "system": "s"})))
    frame = spark.createDataFrame(rows, "conv_id long, record string").selectExpr("*", "'x' AS text")
    got = {r.conv_id: r for r in C.format_records(frame).collect()}
    assert all(C.read_back(got[i].text) == [("user", "q"), ("assistant", "a")] for i in range(len(records)))
    assert len({got[i].layout for i in range(len(records))}) == len(records)
    assert C.read_back(got[50].text) == [("system", "s"), ("user", "i\n\nx"), ("assistant", "o")]
    assert [got[100 + i].layout for i in range(len(odd))] == [None, None, None, None, "messages", None, None]
    assert C.format_records(frame.limit(0)).count() == 0


def test_odd_conversations(spark):
    rows = [(1, 2, "assistant", None), (1, 1, "user", "x"), (1, 1, "user", "x"), (None, None, None, None), (2, 0, "tool", "t")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in C.digests(C.format_records(C.as_records(frame))).collect()}
    assert (got[1].n_turns, got[1].loss_chars) == (3, 0)
    assert got[None].turns_sha256 == sha("\n\n") and got[2].turns_sha256 == sha("tool\nt\n")


# ---- page texts ---------------------------------------------------------------------------------------------

LONG = "A rather long sentence of plain text about nothing at all. " * 6


@pytest.mark.parametrize(
    "html, want",
    [
        (None, ""),
        ("", ""),
        ("  plain &amp; <b>bo</b>ld ", "plain & bold"),
        (f"<nav><a href=x>menu</a></nav><article><h1>T</h1><p>{LONG}<p>b<br>c</article><footer>f</footer>", f"T {LONG}b c"),
        (f"<body><header><a>h</a></header><div class='side-bar'>s</div><main><p>{LONG}</p><form>f<input></form></main>", LONG.strip()),
        (f"<article><p>{LONG}</p><div id=comments><p>{LONG}</p></div><aside>x</aside></article>", LONG.strip()),
        (f"<article><script>a<b</script><style>p{{}}</style><!-- c -> --><p>{LONG}</p><div class='ad'>buy", LONG.strip()),
        (f"<article><ul><li>one<li>two</ul><p>{LONG}</article>", f"one two {LONG.strip()}"),
        (f"<article><p>{LONG}&lt;p&gt; &#233;&eacute</p><p>cut <a hre", f"{LONG}<p> éé cut"),
    ],
)
def test_main_text(html, want):
    assert main_text(html) == " ".join(want.split())


def test_main_text_by_density_alone():
    links = "".join(f"<a href=/{k}>link number {k}</a> " for k in range(30))
    html = f"<body><div>{links}</div><div><div><p>{LONG}</p><p>{LONG}</p></div><div><p>{LONG}</p></div></div><div>{links}</div>"
    assert main_text(html) == " ".join((LONG * 3).split())


def test_threshold_beyond_one_article():
    other = LONG.replace("plain", "other")
    both = " ".join((LONG + other).split())
    two = f"<article><p>{LONG}</p><p>{LONG}</p></article><article><p>{other}</p></article>"
    links = "".join(f"<li><a href=/{k}>link number {k}</a>" for k in range(30))
    page = f"<body><div><ul>{links}</ul></div>{{}}<div><ul>{links}</ul></div>"
    assert main_text(page.format(two)) == " ".join((LONG * 2 + other).split())
    beside = f"<main><p>{LONG}</p></main><div><p>{other}</p></div>"
    assert main_text(page.format(beside)) == both
    # boxes of links in main fall under the threshold, its heading does not go
    box = f"<main><h1>Title</h1><div><ul>{links}</ul></div><div><p>{LONG}</p><p>{other}</p></div></main>"
    assert main_text(page.format(box)) == f"Title {both}"
    assert main_text(f"<article><h1>Title</h1><p>{LONG}</p></article>") == f"Title {LONG.strip()}"


@pytest.mark.parametrize(
    "html, want",
    [
        (f"<body><div class='main no-sidebar'><p>{LONG}</p></div>", LONG),
        (f"<body><div class='content with-sidebar'><p>{LONG}</p></div><div class=sidebar>s</div>", LONG),
        (f"<article><div class='entry-header'><h2>T</h2></div><p>{LONG}</p></article>", f"T {LONG}"),
        (f"<article><div class=header><h1>T</h1></div><p>{LONG}</p></article>", f"T {LONG}"),
        (f"<main><div class=section-header>T</div><p>{LONG}</p><div class=related-work>R</div></main>", f"T {LONG}R"),
        (f"<main><p>{LONG}</p><ol class='search-results'><li>one<li>two</ol></main>", f"{LONG}one two"),
        (f"<body><div id=menu-of-day></div><div class=menu><p>{LONG}</p></div>", LONG),
        (f"<article class='post comments-open'><p>{LONG}</p></article>", LONG),
        # these still go, however long
        (f"<article><p>{LONG}</p><div class='comment-list'><p>{LONG * 3}</p></div></article>", LONG),
        (f"<body><div class='cookie-notice'>{LONG * 3}</div><article><p>{LONG}</p></article>", LONG),
        (f"<body><div class='left-sidebar'><p>{LONG * 3}</p></div><article><p>{LONG}</p></article>", LONG),
        (f"<article><p>{LONG}</p><div class='share-buttons'>x</div><div class='related-posts'><h3>y</h3></div></article>", LONG),
        (f"<body><div id=site-header><h1>S</h1></div><article><p>{LONG}</p></article><div id='page_footer'>f</div>", LONG),
    ],
)
def test_parts_by_name(html, want):
    assert main_text(html) == " ".join(want.split())


def test_deep_and_long_pages():
    deep = "<div>" * 100_000 + "x" + "</div>" * 100_000
    assert main_text(deep) == "x"
    assert len(main_text("<article>" + f"<p>{LONG}</p>" * 5_000 + "</article>")) > 1_000_000
    assert main_text("<" * 50_000).startswith("<") and main_text("<a " * 30_000) == ""


def test_extract_of_odd_pages(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    got = extract(pages)
    assert got.count() == pages.count() and got.where("n_chars != length(text) or n_chars = 0").isEmpty()
    odd = spark.createDataFrame([(None, None, None), (1, "u", "x"), (1, "u", "x")], "page_id long, url string, html string")
    rows = extract(odd.selectExpr("'t' AS text", "*")).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in rows) == [(0, "", 0), (1, "x", 1), (1, "x", 1)]
    assert extract(odd.limit(0)).count() == 0


# ---- mixing -------------------------------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.text("abcdef", min_size=1, max_size=3), st.floats(0.01, 100), min_size=1, max_size=12))
def test_schedule_deviates_less_than_a_block(weights):
    parts = M.shares(weights, 100)
    assert sum(parts.values()) == 100 and min(parts.values()) >= 1
    seen = Counter()
    for place, (source, i, at) in enumerate(M.schedule(parts)):
        assert at == place and i == seen[source]
        seen[source] += 1
        assert all(abs(seen[s] * 100 - n * (place + 1)) < 100 for s, n in parts.items())


@pytest.mark.parametrize(
    "weights",
    [
        {str(i): n**0.7 for i, n in enumerate([40_000, *[4_000] * 18, 3])},
        {"a": 0.9999, "b": 0.0001},
        {str(i): 1 + i % 3 for i in range(1_500)},
    ],
)
def test_unrounded_weights_over_a_long_mix(weights):
    total, seen = sum(map(Fraction, weights.values())), Counter()
    share = {s: Fraction(w) / total for s, w in weights.items()}
    for place, (source, i) in enumerate(islice(M.turns(weights), 25_000), 1):
        assert i == seen[source]
        # between its own places the count only falls behind
        assert i - share[source] * (place - 1) > -1 and i + 1 - share[source] * place < 1
        seen[source] += 1
        if place % 1_000 == 0:
            assert all(abs(seen[s] - w * place) < 1 for s, w in share.items())


def test_mix_of_small_weights_and_many_sources(spark):
    rows = [(i, "x" * 10, "big" if i < 4_000 else "small") for i in range(4_002)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = M.mix(frame, {"big": 0.9995, "small": 0.0005}, block_chars=10).collect()
    big = sorted(r.place for r in mixed if r.source == "big")
    small = sorted(r.place for r in mixed if r.source == "small")
    assert sorted(big + small) == list(range(4_002)) and {r.repeats for r in mixed} == {1}
    assert [p // 2_000 for p in small] == [0, 1]
    many = frame.selectExpr("doc_id", "text", "doc_id % 1200 AS source")
    mixed = M.mix(many, block_chars=10).collect()
    assert len(mixed) == 4_002 and len({r.place for r in mixed}) == 4_002


def test_mix_keeps_rows_and_shares(docs):
    mixed = M.mix(docs, period=50, block_chars=3_000).cache()
    assert mixed.count() == docs.count() and mixed.select(docs.columns).exceptAll(docs).isEmpty()
    blocks = {(r.source, r.block): r for r in mixed.collect()}
    places = [r.place for r in blocks.values()]
    assert len(set(places)) == len(places)
    by_source = Counter(s for s, _ in blocks)
    order = sorted(blocks.values(), key=lambda r: r.place)
    assert all(r.repeats >= 1 for r in order) and len(by_source) > 5
    for source in by_source:
        own = [r.place for r in order if r.source == source]
        assert own == sorted(own) and [r.block for r in order if r.source == source] == sorted(
            r.block for r in order if r.source == source
        )


def test_mix_follows_given_weights(spark):
    text = "x" * 100
    rows = [(i, text, "big" if i < 600 else "small") for i in range(900)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = M.mix(frame, {"big": 1, "small": 1}, period=10, block_chars=1_000).collect()
    assert {r.repeats for r in mixed if r.source == "big"} == {1}
    small = {r.block: r.repeats for r in mixed if r.source == "small"}
    assert set(small.values()) <= {1, 2} and abs(sum(small.values()) - 60) <= 1
    with pytest.raises(ValueError):
        M.mix(frame, {"big": 0, "small": 1})


def test_mix_of_odd_rows(odd):
    mixed = M.mix(odd)
    assert mixed.count() == odd.count() and mixed.columns[-3:] == ["block", "place", "repeats"]
    assert mixed.where("place is null or repeats < 1").isEmpty()
    assert M.mix(odd.limit(0)).count() == 0
