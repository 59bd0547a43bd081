"""Row vectors for the string rules: Spark columns against a plain-Python
statement of the same rules (Python's own strip / splitlines / re semantics)."""

import re

import pytest
from pyspark.sql import functions as F

from quillspark.functions import answers as A
from quillspark.functions import text as T


# text, final answer of a solution, numeric answer: written out by hand
EXPECTED = [
    (None, "", ""), ("", "", ""), ("   ", "", ""), ("\t\n", "", ""), ("42", "42", "42"), (" 42 ", "42", "42"),
    ("so \\boxed{17} done", "17", "so \\boxed{17} done"),
    ("\\boxed{}", "", "\\boxed{}"),
    ("x \\boxed{\\frac{1}{2}} y", "\\frac{1", "x \\boxed{\\frac{1}{2}} y"),  # up to the first closing brace
    ("\\boxed{1} and \\boxed{2}", "1", "\\boxed{1} and \\boxed{2}"),
    ("a\\\\b", "ab", "a\\\\b"),
    ("\\\\\\boxed{3}", "3", "\\\\\\boxed{3}"),
    ("line1\nline2", "line2", "line1"), ("line1\r\nline2\r\n", "line2", "line1\r"),
    ("a\u2028b", "b", "a\u2028b"), ("a\x1cb", "b", "a\x1cb"), ("a\u0085b", "b", "a\u0085b"),
    ("1,234", "1,234", "1234"), ("Answer: 1,234.", "Answer: 1,234", "1234"),
    ("answer - \n 7", "7", "7"), ("The answer is 5", "The answer is 5", "The answer is 5"),
    ("Answer:\n\n 9 \nmore", "more", "9"), ("x\u00a0\u00a0y", "x y", "x\u00a0\u00a0y"),
    ("step\n12  .", "12", "step"), ("answer-3", "answer-3", "3"), ("ANSWER: 4", "ANSWER: 4", "ANSWER: 4"),
    ("\u3000 8 \u3000", "8", "8"), ("a\tb   c", "a b c", "a\tb   c"), ("..5..", "5", "5"),
    ("Answer: \u2028x", "x", "x"), ("\\boxed{a\nb}", "a b", "\\boxed{a"),
]
CASES = [case for case, _, _ in EXPECTED]


@pytest.fixture(scope="module")
def graded(spark):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(CASES)], "i int, t string")
    rows = df.select("i", A.extract_math_answer("t").alias("m"), A.normalize_numeric_answer("t").alias("g"),
                     T.pystrip("t").alias("s"), T.last_line(T.pystrip("t"), stripped=True).alias("l1"),
                     T.last_line("t").alias("l2")).collect()
    return {r["i"]: r for r in rows}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_math_answer(graded, i):
    assert graded[i]["m"] == EXPECTED[i][1]


@pytest.mark.parametrize("i", range(len(CASES)))
def test_numeric_answer(graded, i):
    assert graded[i]["g"] == EXPECTED[i][2]


@pytest.mark.parametrize("i", range(len(CASES)))
def test_strip_and_last_line(graded, i):
    c = CASES[i]
    if c is None:
        assert graded[i]["s"] is None
        return
    assert graded[i]["s"] == c.strip()
    lines = c.strip().splitlines()
    assert graded[i]["l1"] == (lines[-1] if lines else "")
    raw_lines = c.splitlines()
    assert graded[i]["l2"] == (raw_lines[-1] if raw_lines else "")


def test_whitespace_sets_match_python():
    assert sorted(T.WS_CHARS) == sorted(chr(c) for c in range(0x110000) if chr(c).isspace())
    for ch in T.LINE_BREAK_CHARS:
        assert len(("a" + ch + "b").splitlines()) == 2


def test_template_render(spark):
    df = spark.createDataFrame([("q1", None)], "question string, extra string")
    out = df.select(T.render("Q: {{question}} / {{ extra }} / {{missing}}",
                             {"question": F.col("question"), "extra": F.col("extra")}).alias("r")).first()
    assert out["r"] == "Q: q1 /  / "
    with pytest.raises(ValueError):
        T.template_parts("{% for x in y %}{{x}}{% endfor %}")


def test_number_helpers(spark):
    df = spark.createDataFrame([("a 1,200 b 3.5",), ("none",), ("\\frac{1}{2}",), ("50%",)], "t string")
    rows = df.select(A.number_from_text("t").alias("n"),
                     A.to_number(A.latex_to_plain("t")).alias("v")).collect()
    assert rows[0]["n"] == "3.5" and rows[1]["n"] is None
    assert rows[2]["v"] == pytest.approx(0.5) and rows[3]["v"] == pytest.approx(50.0)


def test_random_strings_keep_the_rules(spark):
    """600 seeded random strings: what must hold for any text."""
    import random

    rnd = random.Random(11)
    pieces = [" ", "\t", "\n", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", "\u2028", "\u3000", "\\", "\\\\", "{", "}",
              "\\boxed{", "Answer", "answer", ":", "-", ",", ".", "1", "23", "4,567", "x", "é"]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 12))) for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = df.select("t", A.extract_math_answer("t").alias("m"), A.normalize_numeric_answer("t").alias("g")).collect()
    for r in rows:
        assert r["m"] == r["m"].strip(" .") and r["g"] == r["g"].strip(" .")  # ends are clean
        assert not re.search(r"\s\s", r["m"]) and "\\\\" not in r["m"]  # one space, no double backslash
        assert "," not in r["g"] and "\n" not in r["g"]  # one line, no separators
        for found in (r["m"].replace(" ", ""), r["g"]):  # only characters of the text
            assert set(found) <= set(r["t"])


# answer text, number (None: not a number): written out by hand
NUMBERS = [
    ("1 1/2", 1.5), (r"1\frac{1}{2}", 1.5), (r"-2\frac{3}{4}", -2.75), (".5", 0.5), ("+5", 5.0), ("-3.", -3.0), ("11/2", 5.5),
    (r"\boxed{\frac{1}{2}}", 0.5), (r"\boxed{\boxed{7}}", 7.0), (r"50\%", 50.0), ("10 m", 10.0), ("10 km.", 10.0), ("3 hours", 3.0),
    ("$1,200", 1200.0), (r"\$1,200", 1200.0), ("dog", None), ("Monday", None), ("1/0", None), ("", None), ("(3)/(4)", 0.75),
    (r"\dfrac{-3}{4}", -0.75), (r"\text{12}", 12.0), ("12 34/5", 18.8),
]


def test_numbers_by_hand(spark):
    df = spark.createDataFrame(list(enumerate(t for t, _ in NUMBERS)), "i int, t string")
    got = {r.i: r.v for r in df.select("i", A.to_number(A.latex_to_plain("t")).alias("v")).collect()}
    for i, (t, want) in enumerate(NUMBERS):
        assert (got[i] is None) == (want is None) and (want is None or abs(got[i] - want) < 1e-9), (t, got[i])


def test_units_only_after_digits(spark):
    df = spark.createDataFrame([("dog",), ("Monday",), ("5 kg",), ("kg",), ("12%",), ("%",)], "t string")
    assert [r.s for r in df.select(A.normalize_number_string("t").alias("s")).collect()] == ["dog", "Monday", "5", "kg", "12", "%"]


def test_grading_by_hand(spark):
    from quillspark.operators import scoring as S

    rows = [  # dataset, prediction, reference, correct, error type, numerically correct
        ("math", r"so \boxed{\frac{1}{2}}", "0.5", False, "wrong_value", True),
        ("math", r"\boxed{\frac{1}{2}}", r"\boxed{\frac{1}{3}}", True, "correct", True),  # the grader stops at the first brace
        ("math", r"\boxed{3}", "3", True, "correct", True),
        ("gsm8k", "Answer: 7 km", "7", False, "format_only", True),
        ("gsm8k", "The answer is dog", "do", False, "no_answer_marker", False),
        ("gsm8k", "", "4", False, "empty_prediction", False), ("gsm8k", None, "4", False, "empty_prediction", False),
        ("gsm8k", "Answer: 1 1/2", "1.5", False, "wrong_value", True), ("gsm8k", "Answer: 11/2", "1.5", False, "wrong_value", False),
        ("math", r"\boxed{2\frac{1}{2}}", "2.5", False, "wrong_value", True),
    ]
    df = spark.createDataFrame([(i, *r[:3]) for i, r in enumerate(rows)], "sample_id long, dataset string, prediction string, reference string")
    g = S.grade(df)
    kinds = {r.sample_id: (r.correct, r.error_type) for r in S.error_type(g).collect()}
    numeric = {r.sample_id: r.numeric_correct for r in S.numeric_match(g).collect()}
    for i, r in enumerate(rows):
        assert (*kinds[i], numeric[i]) == r[3:], (r, kinds[i], numeric[i])
    over = spark.createDataFrame([("gsm8k", 3, True), ("math", 2, False)], "dataset string, sample_id long, correct_override boolean")
    changed = {r.sample_id for r in S.rescore(g, over).where("rescored != correct").collect()}
    assert changed == {2, 3}
    assert {r.sample_id for r in S.unparsed(g).collect()} == {4, 5, 6}
