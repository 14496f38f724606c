import pytest
from pyspark.sql import functions as F

from classmap.functions import replies, text
from classmap.operators import abbreviations as ab
from classmap.operators import validation


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v")).alias("o")).first()["o"]


# The worked examples for reading lengths.
DIMENSIONS = [
    ("GEWI PLUS CHUCK EXTENSION - 800mm", ["800"], ["mm"]),
    ("47.0MM L = 2.1m", ["47.0", "2.1"], ["mm", "m"]),
    ("WYE; VENT; 1220MM; EVERTUFF;515 GSM", ["1220"], ["mm"]),
    ("CHUCK EXTENSION - 800mm", ["800"], ["mm"]),
    ("EXPANSION SHELL 20mmR/HAND THD (PRE GROUTED BOLT)", ["20"], ["mm"]),
    ("BOLT AX 2100X24MM C/W AF/BALL/MOLYNUT", ["2100x24"], ["mm"]),
    ("FLAT PLATE 180 X 180 X 45MM", ["180x180x45"], ["mm"]),
    ("KINLOC 47MMX2400MM INDIE GAL", ["47x2400"], ["mm"]),
    ("NUT/PLATE, PULL TEST EQUIPMENT", [], []),
]


@pytest.mark.parametrize("value, values, units", DIMENSIONS)
def test_dimensions(spark, value, values, units):
    assert one(spark, value, text.dimension_values) == values
    assert one(spark, value, text.dimension_units) == units


@pytest.mark.parametrize("value", ["", " ", "a", " x ", "\x1cx\x1f", "é\t", " a  b\n"])
def test_strip(spark, value):
    assert one(spark, value, text.strip) == value.strip()
    assert one(spark, value, text.nonblank) == bool(value.strip())
    assert one(spark, value, text.words) == value.split()


@pytest.mark.parametrize(
    "value, line",
    [
        (None, ""), ("", ""), ("`x`", "x"), ("```\nfoo\nbar```", "foo"), ("\"'a'\"", "a"),
        ("' \"a\" '", "\"a\""), ("\n\n  b  c", "b"), ("` \"q\" `", "q"), ("a\\b", "a\\b"),
    ],
)
def test_clean_single_line(spark, value, line):
    assert one(spark, value, text.clean_single_line) == line


@pytest.mark.parametrize(
    "name, ok",
    [
        (None, False), ("", False), ("Bolt", True), ("Bolt 5", False), ("x" * 60, True),
        ("x" * 61, False), ("a b c d e f g h", True), ("a b c d e f g h i", False), ("٣", False),
    ],
)
def test_main_name_limits(spark, name, ok):
    assert one(spark, name, text.is_valid_main_name) is ok


@pytest.mark.parametrize(
    "value, name",
    [
        ("HOSE; PVC; SUCTION; 50MM", "HOSE PVC SUCTION"), ("HOLLOW BAR R32S/L=3000 mm", "HOLLOW BAR mm"),
        ("5 6 7", "5 6 7"), (None, ""), ("  a b  ", "a b"), ("x, Bolt/Nut 3", "Bolt Nut"),
    ],
)
def test_fallback_name(spark, name, value):
    assert one(spark, value, text.fallback_main_name) == name


def test_numbers(spark):
    df = spark.createDataFrame([("a 1.5 b 20", "20 x 1.5"), ("7", "seven"), ("none", "")], "o string, e string")
    assert [r[0] for r in df.select(text.numbers_preserved("o", "e")).collect()] == [True, False, True]


@pytest.mark.parametrize(
    "value, shown", [(0.00125, "0.12%"), (0.00375, "0.38%"), (1 / 3, "33.33%"), (1.0, "100.00%"), (12.5, "1250.00%"), (0.01005, f"{0.01005 * 100:.2f}%")]
)
def test_percent(spark, value, shown):
    assert one(spark, value, text.format_percent, "double") == shown


def test_text_of_numbers(spark):
    df = spark.createDataFrame([(7948.0, 1e7, 2.5, None)], "a double, b double, c double, d double")
    got = df.select(*[text.join_key(c, "double").alias(c) for c in df.columns]).first()
    assert tuple(got) == ("7948", "10000000", "2.5", None)


def test_level_label(spark):
    df = spark.createDataFrame([("a", 3), ("b", None)], "n string, l int")
    assert [r[0] for r in df.select(text.level_label("n", "l")).collect()] == ["a (L3)", "b"]


# --- replies

def candidates():
    return F.array(
        *[F.struct(F.lit(i).alias("class_id"), F.lit(f"c{i}").alias("class_name")) for i in (200, 7)]
    )


LONG = "x" * 500


@pytest.mark.parametrize(
    "raw, choice, reason",
    [
        ('{"choice_id": "200", "reasoning": " ok "}', "200", "ok"),
        ('{"choice_id": 200}', "200", ""),
        ('Sure! {"choice_id": "7", "reasoning": "a {b}"} bye', "7", "a {b}"),
        ('```json\n{"choice_id": "7",\n "reasoning": "r"}\n```', "7", "r"),
        ("ERROR: quota", None, "ERROR: quota"),
        ("", None, "Unparseable LLM output: "),
        (LONG, None, "Unparseable LLM output: " + "x" * 400),
        ("{}", None, "Unparseable LLM output: {}"),
        ("[1]", None, "Unparseable LLM output: [1]"),
        ("{'choice_id': '7'}", None, "Unparseable LLM output: {'choice_id': '7'}"),
        ('{"choice_id": "7"} or {"choice_id": "200"}', None, 'Unparseable LLM output: {"choice_id": "7"} or {"choice_id": "200"}'),
        ('{"choice_id": "9", "reasoning": "because"}', None, "because"),
        ('{"choice_id": "9", "reasoning": " "}', None, "Invalid choice_id: 9"),
        ('{"choice_id": null}', None, "Invalid choice_id: None"),
        ('{"reasoning": null}', None, "None"),
    ],
)
def test_choices(spark, raw, choice, reason):
    df = spark.createDataFrame([(raw,)], "raw string").withColumn("c", candidates())
    got = df.select(replies.validate_choice("raw", "c").alias("v"), "c").select(
        "v.*", replies.resolve_choice("v.choice_id", "c").alias("name")
    ).first()
    assert tuple(got) == (choice, reason, choice and f"c{choice}")


def test_a_reply_is_parsed_once_however_many_candidates(spark):
    """The whole reply and its braces: two parsers in the plan, none in a candidate's loop."""
    df = spark.createDataFrame([('{"choice_id": "7"}',)], "raw string").withColumn("c", candidates())
    judged = df.withColumn("v", replies.validate_choice("raw", "c"))
    named = judged.select(replies.resolve_choice("v.choice_id", "c").alias("name"))
    plan = named._jdf.queryExecution().analyzed().toString() + named._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("from_json") <= 8
    assert named.first()["name"] == "c7"


def test_a_null_id_among_the_candidates(spark):
    shape = "c array<struct<class_id:bigint,class_name:string>>, raw string"
    rows = [([(None, "none"), (7, "seven"), (7, "other")], '{"choice_id": "7"}'), ([None, (8, "eight")], '{"choice_id": "7"}'), (None, '{"choice_id": "7"}')]
    judged = spark.createDataFrame(rows, shape).withColumn("v", replies.validate_choice("raw", "c"))
    got = judged.select("v.choice_id", replies.resolve_choice("v.choice_id", "c").alias("name")).collect()
    assert [tuple(r) for r in got] == [("7", "seven"), (None, None), (None, None)]


@pytest.mark.parametrize(
    "raw, values, units",
    [
        ('{"values": ["1", 2], "units": ["mm"]}', ["1", "2"], ["mm"]),
        ('[{"values": ["3"], "units": []}, {"values": ["4"]}]', ["3"], []),
        ("[]", [], []), ("[1, 2]", [], []), ("text", [], []), ('"x"', [], []), (None, [], []),
        ('{"values": "abc", "units": ["m"]}', [], ["m"]), ('{"values": [null]}', ["None"], []),
        ('{"values": ["1"]} trailing', [], []),
    ],
)
def test_extractions(spark, raw, values, units):
    got = one(spark, raw, replies.parse_extraction)
    assert (list(got["values"]), list(got["units"])) == (values, units)


# --- abbreviations


def test_list_entries(spark):
    cell = "GALV=Galvanised, C/W=Complete With,BAD, =x, A=b=c,"
    df = spark.createDataFrame([(0, cell, "S"), (1, None, "S"), (2, " ", "T")], "row_pos long, _c0 string, _c1 string")
    got = ab.parse_abbreviations(df).orderBy("row_pos", "entry_pos").collect()
    assert [(r["Code"], r["Description"], r["Sheet"]) for r in got] == [
        ("GALV", "Galvanised", "S"), ("C/W", "Complete With", "S"), ("BAD", "", "S"), ("", "x", "S"),
        ("A", "b=c", "S"), ("", "", "S"), ("", "", "T"),
    ]


ABBR = [
    (0, "AT", "At", "S"), (1, "ATR", "Anchor AT", "S"), (2, "C/W", "Complete With", "S"),
    (3, "AT", "other", "S"), (4, "$x", "cost $1\\", "S"), (5, "7948", "number", "S"),
    (6, " ", "gone", "S"), (7, "NO", None, "S"), (8, "q\\E", "end", "S"), (9, "Z", "zed", "T"), (10, "M.M", "dot", "S"),
]


def replaced(spark, value, **options):
    abbr = spark.createDataFrame(ABBR, "row_pos long, Code string, Description string, Sheet string")
    items = spark.createDataFrame([("S", 0, value, 7948.0, True)], "sheet string, row_pos long, t string, n double, f boolean")
    data, warnings = ab.replace_in_sheets(items, abbr, **options)
    return data.first(), sorted(map(tuple, warnings.collect()), key=str)


@pytest.mark.parametrize(
    "value, options, want",
    [
        ("ATR AT", {}, "Anchor At At"), ("AT AT-AT", {}, "At At-At"), ("XAT AT_ AT1", {}, "XAT AT_ AT1"),
        ("at", {}, "at"), ("at Atr", {"case_sensitive": False}, "At Anchor At"),
        ("XATX", {"whole_tokens": False}, "XAtX"), ("C/W x", {}, "Complete With x"),
        ("$x", {}, "cost $1\\"), ("NO", {}, "NO"), ("a q\\E b", {}, "a end b"), ("MxM M.M", {}, "MxM dot"),
        ("éAT", {}, "éAt"), (" ", {}, " "), (None, {}, None),
    ],
)
def test_replacement(spark, value, options, want):
    row, warnings = replaced(spark, value, **options)
    assert row["t"] == want and row["n"] == "number" and row["f"] is True
    assert warnings == [("ambiguous code", "S", "AT"), ("sheet not found", "T", None)]


def test_many_pairs_are_joined_instead_of_broadcast(spark, monkeypatch):
    monkeypatch.setattr(ab, "PAIR_BYTES", 0)
    assert replaced(spark, "XATX", whole_tokens=False)[0]["t"] == "XAtX"


def test_only_codes_that_can_apply_reach_a_cell(spark):
    """Of a thousand codes in a sheet a cell gets those its words bring in, also by way of
    descriptions."""
    rows = [(i, f"C{i}", f"word{i}", "S") for i in range(1000)]
    rows += [(2000, "LONGCODE", "see MID and C7", "S"), (2001, "MIDX", "never", "S"), (2002, "MID", "C5-C6", "S"), (2003, "##", "hash C9", "S")]
    codes = ab.first_descriptions(ab.trim_fields(spark.createDataFrame(rows, "row_pos long, Code string, Description string, Sheet string")))
    items = spark.createDataFrame([(0, "S", "LONGCODE x C1", 5.0), (1, "S", "none", 1.0), (2, "T", "C1", 2.0), (3, "S", "a ## b", 3.0)], "id long, sheet string, t string, n double")
    found = {r["id"]: {c: [p["code"] for p in own] for c, own in r["pairs"].items()} for r in ab.matched_pairs(items, codes, row="id", texts=["t"], numbers=["n"]).collect()}
    assert found == {0: {"t": ["LONGCODE", "MID", "C1", "C5", "C6", "C7"]}, 3: {"t": ["##"]}}  # C9 comes before ##


def test_matched_codes_replace_like_all_codes(spark):
    import random

    rng = random.Random(6)
    words = ["a", "B", "ab", "A-b", "#", "b#", "é", "x_1", "K", "\u212a", "a b", "\u017f"]
    abbr = [(i, rng.choice(words), " ".join(rng.choice(words) for _ in range(rng.randint(1, 3))), "S") for i in range(12)]
    texts = ["".join(rng.choice([*words, " ", "-", " "]) for _ in range(rng.randint(1, 8))) for _ in range(150)]
    table = spark.createDataFrame(abbr, "row_pos long, Code string, Description string, Sheet string")
    items = spark.createDataFrame([("S", i, t) for i, t in enumerate(texts)], "sheet string, row_pos long, t string")
    pairs = ab.replacement_map(ab.trim_fields(table))
    for case in (True, False):
        every = ab.sheet_pairs(items, pairs, sheet="sheet", spread_by="row_pos")
        want = dict(every.select("row_pos", ab.replace_abbreviations("t", "pairs", case_sensitive=case)).collect())
        got = ab.replace_in_sheets(items, table, case_sensitive=case)[0]
        assert dict(got.select("row_pos", "t").collect()) == want


# --- validation


def test_buckets_and_summary(spark):
    rows = [("a", "b", "c", m) for m in ("a", "b", "c", "d", "", None, "a", "a")]
    df = spark.createDataFrame(rows, "top_1_class_name string, top_2_class_name string, top_3_class_name string, m string")
    bucketed, summary = validation.validate_assignments(df, mapping="m")
    assert sorted(r["match_bucket"] for r in bucketed.collect()) == [
        "mismatch", "no_mapping", "no_mapping", "top1", "top1", "top1", "top2", "top3"
    ]
    assert [tuple(r)[1:] for r in summary.orderBy("line").collect()] == [
        ("Total Items", "8"), ("Total with Mapping", "6"), ("Top-1 Match %", "50.00%"),
        ("Top-2 Match %", "16.67%"), ("Top-3 Match %", "16.67%"), ("Total Match % (Top1-3)", "83.33%"),
        ("False Match / No Match %", "16.67%"),
    ]
    nothing = validation.validate_assignments(df.where("m is null"), mapping="m")[1]
    assert [tuple(r)[1:] for r in nothing.orderBy("line").collect()][2:] == [
        ("Top-1 Match %", "N/A"), ("Top-2 Match %", "N/A"), ("Top-3 Match %", "N/A"),
        ("Total Match %", "N/A"), ("False Match %", "N/A"),
    ]
    numeric = spark.createDataFrame([(1, 2, 3, 0), (1, 2, 3, 2)], "a int, b int, c int, m int")
    got = validation.match_bucket(numeric, top=("a", "b", "c"), mapping="m")
    assert sorted(r["match_bucket"] for r in got.collect()) == ["no_mapping", "top2"]
    with pytest.raises(ValueError):
        validation.match_bucket(numeric, mapping="m")
