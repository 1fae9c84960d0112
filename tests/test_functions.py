"""Text and null rules: one test per trap."""

import random

import distances
import pytest
from pyspark.sql import functions as F

from tallyline.functions import nulls as N
from tallyline.functions import text as T


def one(spark, column, **values):
    """Value of a column over a single row."""
    names = list(values) or ["x"]
    schema = ", ".join(
        f"{n} {'string' if isinstance(v, (str, type(None))) else 'double' if isinstance(v, float) else 'int'}"
        for n, v in values.items()
    ) or "x int"
    return spark.createDataFrame([tuple(values.get(n) for n in names)], schema).select(column.alias("v")).head()["v"]


def test_padding_never_shortens(spark):
    assert one(spark, T.pad_left("d", 3), d="FEDERAL") == "FEDERAL"
    assert one(spark, T.pad_left("d", 3), d="7") == "007"
    assert one(spark, T.pad_left("d", 3), d=None) is None
    assert one(spark, T.pad_int("d", 3), d="0042") == "042"
    assert one(spark, T.pad_int("d", 3), d="x") is None


def test_extract_without_match_is_null(spark):
    assert one(spark, T.extract("s", r"^\d+"), s="abc") is None
    assert one(spark, T.extract("s", r"(?<=No\. )(\d+)"), s="Pct No. 12 x") == "12"


@pytest.mark.parametrize(
    "text, pattern, replacement, expected",
    [
        ("0010", "0", "", "010"),
        ("0010", "^0*", "", "10"),
        ("aXbX", "X", "$1", "a$1bX"),
        ("HBLZ", r"(?<=HBL).$", "", "HBL"),
        ("JJ", "J", "CS", "CSJ"),
        ("none", "X", "y", "none"),
        ("two\nlines X X", "X", "y", "two\nlines y X"),
    ],
)
def test_first_match_only(spark, text, pattern, replacement, expected):
    assert one(spark, T.replace_first("s", pattern, replacement), s=text) == expected


def test_title_case_and_squish(spark):
    assert one(spark, T.title_case("s"), s="PRINCE GEORGE'S-MCHENRY") == "Prince George's-Mchenry"
    assert one(spark, T.squish("s"), s="  a \n\t b  ") == "a b"


def test_punctuation_leaves_symbols(spark):
    assert one(spark, T.remove_all("s", r"\p{P}"), s="a.b,c$+(d)") == "abc$+d"


def test_accents_and_bytes(spark):
    assert one(spark, T.strip_accents("s"), s="JOSÉ NUÑEZ") == "JOSE NUNEZ"
    assert one(spark, T.strip_accents("s"), s="plain") == "plain"
    assert one(spark, T.strip_accents("s"), s=None) is None
    assert one(spark, T.drop_non_ascii("s"), s="José�") == "Jos"


def test_fields_labels_and_tokens(spark):
    assert one(spark, T.has_field("s", "b"), s="a | b|c") is True
    assert one(spark, T.has_field("s", "b"), s="ab|bc") is False
    assert one(spark, T.strip_bracket_suffix("s"), s="Style 4 [2]") == "Style 4"
    assert one(spark, T.null_tokens("s"), s="#N/A") is None
    assert one(spark, T.percent_text(F.col("x")), x=0.0004) == "<1"
    assert one(spark, T.percent_text(F.col("x")), x=0.426) == "43"
    assert one(spark, T.comma_number("x"), x=1234567) == "1,234,567"
    assert one(spark, T.join_sorted(F.array(F.lit("b"), F.lit("a"), F.lit("b")))) == "a|b"


@pytest.mark.parametrize("a, b, osa, lev", [("ab", "ba", 1, 2), ("kitten", "sitting", 3, 3), ("", "abc", 3, 3), ("ca", "abc", 3, 3)])
def test_distances(spark, a, b, osa, lev):
    assert distances.osa(a, b) == osa
    assert one(spark, T.name_distance("a", "b"), a=a, b=b) == osa
    assert one(spark, T.name_distance("a", "b", "levenshtein"), a=a, b=b) == lev


def test_unique_names():
    assert T.unique_names(["Pres", "x", "Pres", None]) == ["Pres...1", "x", "Pres...3", "...4"]


def test_if_else_keeps_unknown_and_replace_where_does_not(spark):
    hit = F.col("p") == "P1"
    assert one(spark, N.if_else(hit, F.lit("new"), F.col("c")), p=None, c="old") is None
    assert one(spark, N.replace_where("c", hit, F.lit("new")), p=None, c="old") == "old"


def test_membership_never_null(spark):
    assert one(spark, N.is_in("s", ["a"]), s=None) is False
    assert one(spark, N.not_in("s", ["a"]), s=None) is True


def test_ladder_skips_unknown_and_recode_keeps_or_drops(spark):
    ladder = N.first_match([(F.col("s") == "a", "A"), (F.col("s").isNull(), "none")], F.lit("other"))
    assert one(spark, ladder, s=None) == "none"
    assert one(spark, N.recode("s", {"a": "A"}), s="b") == "b"
    assert one(spark, N.lookup("s", {"a": "A"}), s="b") is None


def test_three_valued_aggregates(spark):
    rows = [("t", 1), ("t", None), ("f", 0), ("f", None), ("n", None), ("a", 1), ("a", 1)]
    df = spark.createDataFrame(rows, "g string, x int")
    is_one = F.col("x") == 1
    got = {
        r["g"]: (r["a3"], r["o3"], r["at"], r["ss"], r["s0"])
        for r in df.groupBy("g")
        .agg(
            N.all3(is_one).alias("a3"), N.any3(is_one).alias("o3"), N.all_true(is_one).alias("at"),
            N.strict_sum("x").alias("ss"), N.sum0("x").alias("s0"),
        )
        .collect()
    }
    assert got == {
        "t": (None, True, False, None, 1), "f": (False, None, False, None, 0),
        "n": (None, None, False, None, 0), "a": (True, True, True, 2, 2),
    }


def test_ratio_and_number(spark):
    assert one(spark, N.ratio(F.col("x"), F.lit(0)), x=3) is None
    assert one(spark, N.number("s"), s="1x") is None


def test_swap_distance_equals_its_definition_on_random_names(spark):
    draw = random.Random(3)
    names = [None, "", "A", "AA", "Ñu", "uÑ", "😀a", "a😀"] + ["".join(draw.choices("ABC 1é", k=draw.randint(0, 7))) for _ in range(60)]
    rows = spark.createDataFrame([(a, b) for a in names for b in names], "a string, b string")
    for a, b, found in rows.select("a", "b", T.name_distance("a", "b")).collect():
        assert found == (None if a is None or b is None else distances.osa(a, b)), (a, b)


def test_swap_distance_stays_in_the_jvm(spark):
    rows = spark.createDataFrame([("a", "b")], "a string, b string")
    assert "Python" not in rows.select(T.name_distance("a", "b"))._jdf.queryExecution().toString()
