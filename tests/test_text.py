"""Golden cases of the text, year and date functions."""

import pytest
from pyspark.sql import functions as F

from fieldmill.functions import dates as D
from fieldmill.functions import text as X
from fieldmill.functions import years as Y
from fieldmill.operators import refine as R


def evaluate(spark, fn, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, t string")
    return [r.v for r in df.select("i", fn(F.col("t")).alias("v")).orderBy("i").collect()]


def test_split(spark):
    cases = {
        "north<br>south<br>east": ["north", "south", "east"],
        "north<br><br>south": ["north", "south"],
        "k<br>l<br/>m<br />n<BR>": ["k", "l", "m", "n"],
        "one piece": ["one piece"],
        "": [],
        None: [],
        "<br>": [],
        "  <br> a  <br>\t<br\n/> b　": ["a", "b"],
        "<broken> x <br": ["<broken> x <br"],
        "a < b<br>c": ["a < b", "c"],
    }
    assert evaluate(spark, X.split_values, cases) == list(cases.values())


def test_split_is_whole_and_linear_on_long_text(spark):
    text = "<br>".join(f"part {i}" + " " * 50 for i in range(20_000)) + "<br>" * 50_000
    (got,) = evaluate(spark, X.split_values, [text])
    assert got == [f"part {i}" for i in range(20_000)]


def test_every_white_space_is_trimmed(spark):
    texts = [f"{c}{d}a{c} {d}b{d}{c}" for c in X.WHITESPACE for d in X.WHITESPACE] + ["é", "a\x7f", "b\x1f", ":", " : ", "a:: "]
    squeezed = [" ".join(t.split()) for t in texts]
    assert evaluate(spark, X.collapse_whitespace, texts) == squeezed
    assert evaluate(spark, X.flat_text, [f"<br> {t}<br/> " for t in texts]) == squeezed
    assert evaluate(spark, X.split_values, texts) == [[t.strip()] for t in texts]
    assert evaluate(spark, X.strip_colons, texts) == [t.strip().rstrip(":").strip() for t in texts]


def test_split_join_split_is_identity(spark):
    texts = ["a<br>b", "<br/> x <br> y<BR />z", "one", ""]
    again = lambda t: X.split_values(F.array_join(X.split_values(t), "<br>"))
    assert evaluate(spark, again, texts) == evaluate(spark, X.split_values, texts)


def test_has_breaks(spark):
    assert evaluate(spark, X.has_breaks, ["a<br>b", "a", "", None]) == [True, False, False, False]


def test_structure_type(spark):
    cases = {
        "V1<br>V2": "simple",
        "V1": "simple",
        None: "simple",
        "<strong>Site</strong><br>a<br>b": "key_with_sub_values",
        "<strong>a:</strong> 1<br><strong>b:</strong> 2": "key_value_pairs",
        "<strong>a:</strong> 1<br><STRONG>b:</STRONG> 2<br><B>Note:</b> n": "key_value_pairs_with_notes",
        '<strong class="x">a</strong>': "simple",
        "<strong>a\n</strong>": "simple",
        "<strong>a\r</strong>": "key_with_sub_values",
    }
    assert evaluate(spark, X.structure_type, cases) == list(cases.values())


def refine(spark, text, **options):
    df = spark.createDataFrame([("e", 0, "n", text)], "entity string, pos int, name string, data string")
    return R.refine_fields(df, **options).first()


@pytest.mark.parametrize(
    "text, flag",
    [
        ("V1<br>V2", True),
        ("V1", False),
        (None, False),
        ("<strong>Site</strong><br>a<br>b", False),
        ("<strong>a:</strong> 1<br><strong>b:</strong> 2", True),
        ("<strong>a:</strong> 1<br><strong>b:</strong> 2<br><b>note:</b> n", False),
    ],
)
def test_multi_flag(spark, text, flag):
    assert refine(spark, text).is_multi_valued is flag


def test_multi_flag_option_for_notes(spark):
    text = "<strong>a:</strong> 1<br><strong>b:</strong> 2<br><b>note:</b> n"
    assert refine(spark, text, notes_multi_valued=True).is_multi_valued is True


@pytest.mark.parametrize(
    "text, expected",
    [
        (
            "<strong>1998:</strong> 5 t<br><br><strong>1999:</strong> 7 t",
            [("1998", "5 t", None, 0), ("1999", "7 t", None, 1)],
        ),
        (
            "lost<br><strong>tolls:</strong> 9 coins<br><b>note:</b> mid  note<br>"
            "<strong>spend::</strong> $7<br><strong>e:</strong><br><b>Note: </b>last<br/>one",
            [
                ("tolls", "9 coins", None, 0),
                ("spend", "$7", None, 1),
                ("note", "mid note", None, 3),
                ("note", "last one", None, 4),
            ],
        ),
        (
            "<p><strong>A:</strong> 1 <em>x</em></p><p><strong>B:</strong> 2 (2020)</p>",
            [("A", "1 <em>x</em>", None, 0), ("B", "2 (2020)", "2020", 1)],
        ),
        (
            "<div><strong><em>A</em>:</strong> <span>in</span> out</div> gone<strong>B</strong>  2",
            [("A", "<span>in</span> out", None, 0), ("B", "2", None, 1)],
        ),
    ],
)
def test_keyed_values(spark, text, expected):
    row = refine(spark, text)
    assert [(v.key, v["value"], v.year, v.order) for v in row["values"]] == expected


def test_sub_values(spark):
    row = refine(spark, "<strong>Phone and fax</strong><br><br>www.x (2021)<br><br>c@x")
    (item,) = row["values"]
    assert (item.key, item["value"], item.order) == ("Phone and fax", None, 0)
    assert [(s["value"], s.year) for s in item.sub_values] == [("www.x (2021)", "2021"), ("c@x", None)]
    assert refine(spark, "<strong>k:</strong>")["values"][0].sub_values == []


def test_decode_entities_for_keyed_text_only(spark):
    keyed = refine(spark, "<strong>a</strong> 1 &lt; 2<br>x&amp;lt;", decode_entities=True)
    assert [s["value"] for s in keyed["values"][0].sub_values] == ["1 < 2", "x&lt;"]
    assert refine(spark, "1 &lt; 2", decode_entities=True)["values"][0]["value"] == "1 &lt; 2"


def test_years(spark):
    cases = {
        "7 kg per head (2019 est.)": "2019",
        "Counted in (2018)": "2018",
        "44 km (2017 est.) (road 30/rail 14)": "2017",
        "Between (2011) and (2012 est.)": None,
        "x" * 113 + " (2024)": "2024",
        "x" * 114 + " (2024)": None,
        "(2024 est)": None,
        "(24)": None,
        "": None,
        None: None,
    }
    assert evaluate(spark, Y.year_tag, cases) == list(cases.values())
    two = lambda t: Y.year_tag(t, max_years=2)
    assert evaluate(spark, two, ["(2023) and (2024 est.)", "(1) (2001)"]) == ["2024", "2001"]
    assert evaluate(spark, Y.is_data_point, ["", None, "x", "(2001) (2002)"]) == [
        False,
        False,
        True,
        False,
    ]


def test_dates(spark):
    cases = {
        "June 30, 2021": "2021-06-30",
        "30 June 2021": "2021-06-30",
        "  30 june 2021 ": "2021-06-30",
        "June 2021": "2021-06-01",
        "2021": "2021-01-01",
        "Jun 30, 2021": "2021-01-01",
        "February 30, 2021": "2021-01-01",
        "31 June 2021": "2021-06-01",
        "2021-10-28": "2021-01-01",
        "updated: May 1, 2024": "2024-05-01",
        "soon": "soon",
        "": None,
        None: None,
    }
    assert evaluate(spark, D.normalize_date, cases) == list(cases.values())
    iso = lambda t: D.normalize_date(t, iso_first=True)
    assert evaluate(spark, iso, ["2021-10-28", "2021-13-40"]) == ["2021-10-28", "2021-01-01"]
