"""Keyed text in any nesting against a tree built node by node, and character references."""

import html
import random
import re
from html.entities import html5
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from fieldmill.functions import markup as K
from fieldmill.functions import text as X
from fieldmill.operators.refine import refine_fields


TAG = re.compile("<[^>]*>")


class Node:
    def __init__(self, name="", start="", parent=None):
        self.name, self.start, self.parent, self.children = name, start, parent, []

    def __str__(self):
        end = f"</{self.name}>" if self.name and self.name not in K.VOID else ""
        return self.start + "".join(map(str, self.children)) + end

    def inner(self):
        return "".join(map(str, self.children))

    def walk(self):
        for child in self.children:
            if isinstance(child, Node):
                yield child
                yield from child.walk()


class Tree(HTMLParser):
    def __init__(self, text):
        super().__init__(convert_charrefs=False)
        self.top = self.root = Node()
        self.feed(text)
        self.close()

    def handle_starttag(self, tag, attrs):
        node = Node(tag, self.get_starttag_text(), self.top)
        self.top.children.append(node)
        if tag not in K.VOID:
            self.top = node

    def handle_endtag(self, tag):
        node = self.top
        while node is not self.root and node.name != tag:
            node = node.parent
        if node is not self.root:
            self.top = node.parent

    def handle_data(self, data):
        self.top.children.append(data)


def expected(text, noted):
    nodes = list(Tree(text).root.walk())
    strongs = [n for n in nodes if n.name == "strong"]
    notes = [
        n
        for n in nodes
        if n.name == "b" and [type(c) for c in n.children] == [str] and "note:" in n.inner().lower()
    ]

    def behind(node, stops):
        siblings = node.parent.children
        out = ""
        for sibling in siblings[siblings.index(node) + 1 :]:
            if any(sibling is s for s in stops):
                break
            out += str(sibling)
        return out

    pairs = [
        (s.inner(), behind(s, strongs[i + 1 : i + 2] + (notes if noted else [])), i)
        for i, s in enumerate(strongs)
    ]
    if noted:
        pairs += [("note", behind(n, strongs + notes), len(strongs) + i) for i, n in enumerate(notes)]
    return pairs


def test_any_nesting_equals_a_tree(spark):
    parts = (
        "<p> </p> <div> </div> <i> </i> <strong> </strong> <strong>k:</strong> <strong>m</strong> <b>note:</b> "
        "<b>Note: x</b> <b> </b> <br> <hr> </u> v1 w2 <u>in</u> <td> </td>"
    ).split(" ")
    chosen = random.Random(5)
    texts = ["".join(chosen.choice(parts) for _ in range(chosen.randrange(1, 22))) for _ in range(600)]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4)
    for noted in (False, True):
        rows = frame.select("i", K.nested_contents(F.col("t"), F.lit(noted)).alias("c")).collect()
        for i, contents in rows:
            # of a key only the text counts
            got = [(TAG.sub("", k), c, n) for k, c, n in contents]
            assert got == [(TAG.sub("", k), c, n) for k, c, n in expected(texts[i], noted)], texts[i]


def _odd_texts(chosen, count):
    parts = (
        "<p> </p> <div> </div> <i> </i> <strong> </strong> <strong>k:</strong> <STRONG>z</Strong~> <b>note:</b> "
        "<b>Note:~x</b> <b> </b> <br> <hr> </u> v1 w2 < > <!--c--> <a~href='x>y'> </a> <a~href=\"x\"> "
        "<script>a<b</script> </script> <x/> <strong~/> <strong~id=\"1\"> <a:b> </a:b> <b>a<br>note:</b> "
        "<b~x>n<note:</b> <img~alt='<strong>'> </p~x> </br> <p~a/> \x01 \x02 note: \" ' \n <!d> <strongs> </strongs>"
    ).split(" ")
    for _ in range(count):
        pool = parts[: 18 if chosen.random() < 0.5 else None]
        yield "".join(chosen.choice(pool).replace("~", " ") for _ in range(chosen.randrange(1, 22)))


def _closed_texts(chosen, count):
    def inside(depth):
        out = []
        for _ in range(chosen.randrange(4)):
            kind = chosen.random()
            if kind < 0.3 or depth > K.DEPTH + 2:
                out.append(chosen.choice(["v", "w ", "<br>", "< ", "x\n"]))
            elif kind < 0.5:
                out.append(f"<strong>k{inside(depth + 1) if chosen.random() < 0.2 else ':'}</strong>")
            elif kind < 0.6:
                out.append(chosen.choice(["<b>note:</b>", "<b>x</b>", "<b> NOTE: y</b>"]))
            else:
                name = chosen.choice(["p", "div", "b", "i", "td"])
                out.append(f"<{name}>{inside(depth + 1)}</{name}>")
        return "".join(out)

    return [inside(0) + inside(1) + inside(0) for _ in range(count)]


def test_patterns_read_what_the_walk_reads(spark):
    chosen = random.Random(7)
    texts = [*_odd_texts(chosen, 3000), *_closed_texts(chosen, 2000)]
    deep = "<div>" * (K.DEPTH + 3) + "<strong>k:</strong> v" + "</div>" * (K.DEPTH + 3)
    # a dropped end tag in a note; text that would become a tag without what is dropped behind it
    texts += [deep, "<b>Note:</i>x</b> y", "<strong>k</strong> <</u>b>v", "<strong>k<", "<p><strong>k</strong> <i>v", "", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4)
    for noted in (False, True):
        read = [f(F.col("t"), F.lit(noted)) for f in (K.nested_contents, K.walked_contents)]
        for row in frame.select("i", read[0].alias("a"), read[1].alias("b")).collect():
            # of a key only the text counts
            patterns, walk = ([(TAG.sub("", k), c, n) for k, c, n in x or ()] for x in (row["a"], row["b"]))
            assert patterns == walk, texts[row["i"]]


def test_closed_and_mended_text_is_read_by_patterns(spark):
    frame = spark.range(1).select(
        F.expr(f"'<p><strong>k:</strong> <i>v</i></p>' RLIKE {K._literal(K._REGULAR)}"),
        F.expr(K._mended("'<div><strong>k:</strong> <i>x</div></em> y<td>z'")),
    )
    assert tuple(frame.first()) == (True, "<div><strong>k:</strong> <i>x</i></div> y<td>z</td>")


def test_flat_text_reads_the_same_either_way(spark):
    parts = ["<strong>k:</strong>", "<em>x</em>", "<b>note:</b>", "<br>", "<br />", "text ", "(2020) ", "<STRONG>a</STRONG>"]
    chosen = random.Random(6)
    texts = ["".join(chosen.choice(parts) for _ in range(chosen.randrange(2, 14))) for _ in range(200)]
    frame = spark.createDataFrame([(t, None) for t in texts], "data string, media string").repartition(2)
    flat = refine_fields(frame.withColumn("t", F.col("data")))
    nested = refine_fields(frame.withColumn("t", F.col("data")).withColumn("data", F.concat("data", F.lit("<hr>"))))
    assert frame.select(K.is_flat(F.col("data")).alias("f")).where("NOT f").count() == 0
    assert frame.select(K.is_flat(F.concat("data", F.lit("<hr>"))).alias("f")).where("f").count() == 0

    def read(df):
        out = {}
        for r in df.where(F.col("structure_type") != X.SIMPLE).collect():
            values = [(v.key, (v["value"] or "").replace("<hr>", "").strip(), v.order) for v in r["values"]]
            out[r["t"]] = [v for v in values if v[1] or r["structure_type"] == X.KEY_WITH_SUB_VALUES]
        return out

    assert read(flat) == read(nested)


@pytest.mark.parametrize(
    "text,values",
    [
        (
            "<p><strong>k1:</strong> v1 <span>a <em>b</em></span></p><p>tail</p><p><strong>k2:</strong> v2</p>",
            [("k1", "v1 <span>a <em>b</em></span>", 0), ("k2", "v2", 1)],
        ),
        ("<h3><strong>k1:</strong> v1</h3>tail<h3><strong>k2:</strong> v2</h3>", [("k1", "v1", 0), ("k2", "v2", 1)]),
        ("<b><strong>k1:</strong></b> v1 <b><strong>k2:</strong> v2</b>", [("k2", "v2", 1)]),
        ("<section><strong>k1:</strong> v1<strong>k2:</strong> v2</section>after", [("k1", "v1", 0), ("k2", "v2", 1)]),
        (
            "<strong>k1:</strong> v1 <!-- <p> --><a href='x>y'>z</a> <script>if (a<b) '</p>'</script><strong>k2:</strong> 2 < 3",
            [("k1", "v1 <a href='x>y'>z</a> <script>if (a<b) '</p>'</script>", 0), ("k2", "2 < 3", 1)],
        ),
    ],
)
def test_wrapped_pairs(spark, text, values):
    frame = spark.createDataFrame([(text, None)], "data string, media string")
    (row,) = refine_fields(frame).collect()
    assert [(v.key, v["value"], v.order) for v in row["values"]] == values


def test_references_decode_once(spark):
    texts = [
        "caf&eacute; &#8212; &amp;lt; &#x1F600; &copy 20 &nosuch; & &#150; &#0; &#xD800; &#99999999999; &#;",
        "",
        "plain",
        "&amp;amp;amp;&&&;",
        None,
    ]
    texts += [f"a&{name};b" for name in html5 if name.endswith(";") for name in [name[:-1]]]
    texts += [f"&#{n};&#x{n:x}" for n in (1, 38, 200, 255, 256, 8364, 65533, 0x10FFFF)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(4)
    got = dict(frame.select("i", K.decode_references(F.col("t"))).collect())
    first = "café — &lt; \U0001f600 © 20 &nosuch; & – � � � &#;"
    assert got[0] == first
    for i, text in enumerate(texts[1:], 1):
        if text and text.startswith("&#"):
            code = int(text[2 : text.index(";")])
            assert got[i] == chr(code) * 2
        else:
            assert got[i] == (None if text is None else html.unescape(text)), text


def test_decoded_values_keep_their_markup(spark):
    text = "<strong>A &amp; B:</strong> v &lt;1 <em>a &amp; &eacute;</em> &#8212;<p><strong>c</strong> &amp;lt;</p>"
    frame = spark.createDataFrame([(text, None)], "data string, media string")
    (row,) = refine_fields(frame, decode_entities=True).collect()
    assert [(v.key, v["value"]) for v in row["values"]] == [
        ("A & B", "v <1 <em>a &amp; é</em> —<p><strong>c</strong> &amp;lt;</p>"),
        ("c", "&lt;"),
    ]
