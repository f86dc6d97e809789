"""Column functions against values worked out by hand."""

import zlib

import pytest
from pyspark.sql import functions as F, types as T

from shelfsync.functions import compare, logic, numbers, paths, registry, rtf, text


def one(spark, column, **values):
    """Value of a column over a single row."""
    types = {str: "string", int: "int", float: "double", bool: "boolean"}
    schema = ", ".join(f"{k} {types[type(v)] if v is not None else 'string'}" for k, v in values.items()) or "x int"
    row = tuple(values.values()) or (1,)
    return spark.createDataFrame([row], schema).select(column.alias("r")).first()["r"]


DEFAULT_CASES = [
    ("", [lambda c: logic.default(c, "none")], "none"),
    ("own", [lambda c: logic.default(c, "none")], "own"),
    ("", [lambda c: logic.default(c, F.col("other"))], "Other"),
    ("", [lambda c: logic.default(c, text.concat(F.col("other"), F.lit(" end")))], "Other end"),
    ("   ", [text.trim, text.null_if_empty, lambda c: logic.default(c, text.concat(F.col("other"), F.lit(" end")))], "Other end"),
    (None, [lambda c: logic.default(c, "a: b")], "a: b"),
    (None, [lambda c: logic.default(c, "n/a")], "n/a"),
    ("  ", [text.trim, text.null_if_empty, lambda c: logic.default(c, text.concat(F.col("other"), F.lit("!")))], "Other!"),
]


@pytest.mark.parametrize("value,steps,expected", DEFAULT_CASES)
def test_default_pipe(spark, value, steps, expected):
    assert one(spark, registry.pipe(F.col("v"), *steps), v=value, other="Other") == expected


def test_trim_set_and_blank(spark):
    assert one(spark, text.trim(F.col("v")), v="\x00\x0b\t x y \r\n") == "x y"
    assert one(spark, text.is_blank(F.col("v")), v=" \x00\t") is True
    assert one(spark, text.is_blank(F.col("v")), v=None) is True


@pytest.mark.parametrize(
    "value,expected",
    [("a\\b\\c.txt", "c.txt"), ("a/b/", "b"), ("/", ""), ("", ""), (None, None), ("x\n", "x\n"), ("a//b//", "b")],
)
def test_basename(spark, value, expected):
    assert one(spark, text.basename(F.col("v")), v=value) == expected


@pytest.mark.parametrize(
    "value,pipe_form,article_form",
    [
        ("Müller & Söhne", "mueller-und-soehne", "mueller-soehne"),
        ("Café  Größe ÄÖ!", "cafe-groesse-aeoe", "caf-groesse-aeoe"),
        (" -- ", "", ""),
        (None, "", ""),
    ],
)
def test_slugify(spark, value, pipe_form, article_form):
    assert one(spark, text.slugify(F.col("v")), v=value) == pipe_form
    assert one(spark, text.slugify(F.col("v"), translit=False), v=value) == article_form


@pytest.mark.parametrize(
    "value,expected",
    [
        ("<p class=\"a>b\">x</p>", "x"),
        ("a < b <b>c</b>", "a < b c"),
        ("a<!-- <b> -- x -->b", "ab"),
        ("cut <unfinished", "cut "),
        ("x<a <b>y>z", "xz"),
        ("{\\rtf1\\b Hello\\b0 <i>you</i>}", "Hello you"),
        (None, None),
    ],
)
def test_remove_html(spark, value, expected):
    assert one(spark, text.remove_html(F.col("v")), v=value) == expected


RTF = r"{\rtf1\ansi\ansicpg1252{\fonttbl{\f0 Arial;}}{\colortbl;\red0;}{\*\generator x;}{\info{\title t}}\f0\fs20 "


@pytest.mark.parametrize(
    "value,expected",
    [
        (RTF + r"Hello \b World\b0!\par Gr\'f6\'dfe\line 2\par}", "Hello World !<br>Größe<br>2"),
        (RTF + "a\\" + r"u8364?b\~c\_d \emdash e \bullet f}", "a€b c-d — e • f"),
        (RTF + r"\u-3913?x\tab y}", chr(65536 - 3913) + "x y"),
        ("{\\rtf1 \\pard\\par\\par   \\par}", ""),
        ("plain\r\n\r\n  second   line \n\n\n\nthird", "plain<br>second line<br>third"),
        ("Arial, Times-New;body; rest", "body; rest"),
        ("   ", ""),
        ("", ""),
        (None, None),
    ],
)
def test_rtf_to_html(spark, value, expected):
    assert one(spark, rtf.rtf_to_html(F.col("v")), v=value) == expected


def test_plain_text_needs_no_python(spark):
    plan = spark.createDataFrame([("a",)], "v string").select(rtf.rtf_to_html(F.col("v"), may_hold_rtf=False))
    assert "ArrowEvalPython" not in plan._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "value,decimal,whole",
    [
        ("1,5", 1.5, None), ("12.7", 12.7, 12), ("-3.9", -3.9, -3), ("1e3", 1000.0, 1000), (" 7 ", 7.0, 7), ("5.", 5.0, 5), (".5", 0.5, 0),
        ("1.234,56", None, None), ("NaN", None, None), ("1d", None, None), ("", None, None), (None, None, None),
        ("9007199254740993", 9007199254740992.0, 9007199254740993),
    ],
)
def test_numbers(spark, value, decimal, whole):
    assert one(spark, numbers.to_decimal(F.col("v")), v=value) == decimal
    assert one(spark, numbers.to_int(F.col("v")), v=value) == whole


@pytest.mark.parametrize(
    "value,expected",
    [("ja", 1), (" YES", 1), ("1", 1), ("1.9", 1), ("2", 0), ("0", 0), ("true", 1), ("nein", 0), ("", 0), (None, 0), (1, 1), (True, 1), (False, 0)],
)
def test_bool_to_int(spark, value, expected):
    assert one(spark, numbers.bool_to_int(F.col("v")), v=value) == expected


@pytest.mark.parametrize(
    "value,expected",
    [(None, 0), ("19", 1), ("19.05", 1), ("6.95", 2), ("0.05", 0), ("16.5", 17), ("7 %", 2), ("abc", 0), (19.0, 1), ("-2.5", -3)],
)
def test_tax_map(spark, value, expected):
    assert one(spark, numbers.tax_map(F.col("v")), v=value) == expected


@pytest.mark.parametrize(
    "seconds,expected", [(45.24, "45.2s"), (83.0, "1m 23s"), (7500.0, "2h 5m"), (0.0, "0.0s"), (3600.0, "1h 0m")]
)
def test_format_duration(spark, seconds, expected):
    assert one(spark, numbers.format_duration(F.col("v")), v=seconds) == expected


def test_convert(spark):
    assert one(spark, numbers.convert(F.col("v"), "datetime"), v="2024-05-06 07:08:09") == "2024-05-06T07:08:09+00:00"
    assert one(spark, numbers.convert(F.col("v"), "datetime"), v="soon") is None
    with pytest.raises(ValueError):
        numbers.convert(F.lit("1"), "colour")


@pytest.mark.parametrize(
    "path,expected",
    [
        ("srcFiles/Artikel/A1/x.jpg", (1, "A1", None)),
        ("a\\Warengruppen\\Holz\\x.jpg", (2, None, "Holz")),
        ("warengruppen/Holz/warengruppen/Stein/ARTIKEL/ 5 /x", (1, "5", "Stein")),
        ("artikel/1/warengruppen/2/x", (1, "1", None)),
        ("warengruppen/artikel/7", (1, "7", "artikel")),
        ("x/artikel", (0, None, None)),
        ("", (0, None, None)),
        (None, (0, None, None)),
    ],
)
def test_media_owner(spark, path, expected):
    assert tuple(one(spark, logic.media_owner(F.col("v")), v=path)) == expected


@pytest.mark.parametrize(
    "kind,article,category,expected",
    [
        ("1", "A", "C", ("article", "A")), ("1", " ", "C", (None, None)), ("2", "A", "C", ("category", "C")), ("2", "A", None, (None, None)),
        (None, "A", "C", ("article", "A")), ("", "", " C ", ("category", "C")), ("7", None, None, (None, None)),
    ],
)
def test_media_entity(spark, kind, article, category, expected):
    columns = [F.col("k"), F.col("a"), F.col("c")]
    values = dict(k=kind, a=article, c=category)
    assert (one(spark, logic.media_entity_type(*columns), **values), one(spark, logic.media_entity_id(*columns), **values)) == expected


def test_paths(spark):
    name = paths.vault_name("{file_name}", {"file_name": F.col("v")}, F.lit("jpg"))
    assert one(spark, name, v="Größe 1/x.JPG") == "Gr_e_1_x.JPG"
    assert one(spark, paths.vault_name("{nope}-{v}", {"v": F.col("v")}, F.lit("png")), v="a") == "nope_-a.png"
    assert one(spark, paths.vault_path("/b/", F.col("v"), F.lit("f")), v="/sub") == "/b/sub/f"
    assert one(spark, paths.relative_path(F.col("v"), "/a/b/"), v="/a/bc/d") == "/a/bc/d"
    assert one(spark, paths.stem(F.col("v")), v="a.tar.gz") == "a.tar"
    assert one(spark, paths.ext(F.col("v")), v="noext") == ""


# left, right, left type, right type, whether they differ
LOOSE = [
    ("1.0", "1", "string", "string", False), ("1", "01", "string", "string", False), ("1e1", "10", "string", "string", False),
    ("abc", "ABC", "string", "string", True), (" 1", "1 ", "string", "string", False), ("1", "1x", "string", "string", True),
    (None, "", "string", "string", False), (None, "0", "string", "string", True), (None, None, "string", "string", False),
    (None, 0, "string", "int", False), (0, None, "int", "string", False), (5, None, "int", "int", True), (5, "5.0", "int", "string", False),
    (0, "", "int", "string", True), (0, "abc", "int", "string", True), (1.5, "1.50", "double", "string", False),
    (True, "1", "boolean", "string", False), (True, "0", "boolean", "string", True), (None, False, "string", "boolean", False),
    (None, True, "string", "boolean", True), (1, 1.0, "int", "double", False),
    ("9007199254740993", "9007199254740992", "string", "string", True),
]


@pytest.mark.parametrize("a,b,type_a,type_b,expected", LOOSE)
def test_loose_compare(spark, a, b, type_a, type_b, expected):
    row = spark.createDataFrame([(a, b)], f"a {type_a}, b {type_b}")
    kinds = row.schema["a"].dataType, row.schema["b"].dataType
    assert row.select(compare.loose_ne("a", "b", *kinds)).first()[0] is expected
    assert row.select(compare.loose_ne("b", "a", *reversed(kinds))).first()[0] is expected


def test_file_token(spark):
    token = lambda algo: one(spark, compare.file_token(F.col("m"), F.col("s"), algo), m="t", s=5)
    assert token("mtime_size") == "t|5"
    assert len(token("md5")) == 32 and len(token("sha256")) == 64
    assert token("crc32b") == f"{zlib.crc32(b't|5'):08x}"
    assert token("sha256") == token("unknown")
    with pytest.raises(ValueError):
        compare.file_token(F.col("m"), F.col("s"), "xxh3")


@pytest.mark.parametrize("a,b,differ", [("9007199254740993001", "9007199254740993002", True), ("9007199254740993001", " +09007199254740993001", False), ("-0", "0", False), ("-00012", "-12", False), ("1" * 40, "1" * 39 + "2", True), ("1e3", "1000", False)])
def test_long_numbers_compare_exactly(spark, a, b, differ):
    row = spark.createDataFrame([(a, b)], "a string, b string")
    kinds = row.schema["a"].dataType, row.schema["b"].dataType
    assert row.select(compare.loose_ne("a", "b", *kinds)).first()[0] is differ
    left, right = row.selectExpr(compare.canonical("a", kinds[0]), compare.canonical("b", kinds[1])).first()
    assert (left != right) is differ


def test_to_int_is_exact(spark):
    assert one(spark, numbers.to_int(F.col("v")), v="9007199254740993001") == 9007199254740993001
    assert one(spark, numbers.to_int(F.col("v")), v="9" * 30) is None


def test_letters_without_marks(spark):
    assert one(spark, text.slugify(F.col("v")), v="Smørrebrød łódź Œuvre Đặng ĲSSEL") == "smorrebrod-lodz-oeuvre-dang-ijssel"


def test_case_keys(spark):
    assert one(spark, logic.case(F.col("v"), {"0": None}), v="0") is None
    assert one(spark, logic.case(F.col("v"), {None: "x"}), v=None) == "x"
    assert one(spark, logic.case(F.col("v"), {"a": "x"}), v="b") == "b"
    assert one(spark, logic.case(F.col("v"), {True: 1, False: 0}), v="true") == 1


def test_context(spark):
    empty = F.create_map().cast(T.MapType(T.StringType(), T.StringType()))
    assert one(spark, logic.encode_context(empty)) is None
    assert one(spark, logic.encode_context(F.create_map(F.lit("ü/x"), F.lit("y")))) == '{"ü/x":"y"}'
    assert one(spark, logic.decode_context(F.col("v")), v="{broken")["text"] == "{broken"


def test_registry(spark):
    names = registry.Registry()
    assert names.has("trim") and not names.has("nothing") and names.get("nothing") is None
    assert one(spark, names.apply("nothing", F.col("v")), v=" a ") == " a "
    names.register("boom", registry.guarded(lambda v: 1 / 0))
    assert one(spark, names.pipe(F.col("v"), "trim", "boom"), v=" a ") == "a"


def test_now_is_the_time_of_the_run(spark):
    from datetime import datetime

    assert one(spark, numbers.now(datetime(2024, 1, 2, 3, 4, 5, 6))) == "2024-01-02T03:04:05+00:00"
