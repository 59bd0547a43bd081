"""Answers by hand: boxes of any depth, braceless fractions, units, repeated
predictions and verdicts."""

import random

import pytest

from quillspark.functions import answers as A
from quillspark.operators import scoring as S

BOXES = [  # text, content of the first closed box
    (r"\boxed{5}", "5"), (r"so \boxed{\frac{1}{2}} ok", r"\frac{1}{2}"), (r"\boxed{1 \boxed{2}", "2"), (r"\boxed{a}\boxed{b}", "a"),
    (r"\boxed{}", ""), (r"\boxed{", None), ("no box", None), ("", None), (None, None), (r"boxed{5}", None), (r"} \boxed{{}{x}} }", "{}{x}"),
    (r"\boxed{\left\{ 1, 2 \right.} end", r"\left\{ 1, 2 \right."), (r"\boxed{\{1\}}", r"\{1\}"), (r"\boxed{a\\{b}}", r"a\\{b}"),
    (r"\boxed{\boxed{\boxed{7}}}", r"\boxed{\boxed{7}}"), (r"{ \boxed{3} ", "3"), ("\\boxed{é😀}x", "é😀"), (r"\boxed{ { \boxed{4} ", "4"),
    (r"\boxed {5}", None), (r"\\boxed{6}", "6"),
]


def test_boxes_by_hand(spark):
    df = spark.createDataFrame(list(enumerate(t for t, _ in BOXES)), "i int, t string")
    got = {r.i: r.b for r in df.select("i", A.boxed_answer("t").alias("b")).collect()}
    assert [got[i] for i in range(len(BOXES))] == [b for _, b in BOXES]


def by_stack(t):
    """First closed box, with a stack."""
    stack, closed = [], {}
    for i, ch in enumerate(t):
        if i and t[i - 1] == "\\" and (i < 2 or t[i - 2] != "\\"):
            continue
        if ch == "{":
            stack.append(i)
        elif ch == "}" and stack:
            closed[stack.pop()] = i
    for i in sorted(closed):
        if t[:i + 1].endswith("\\boxed{"):
            return t[i + 1:closed[i]]
    return None


def test_boxes_like_a_stack(spark):
    rnd = random.Random(3)
    parts = ["{", "}", "\\boxed{", "\\{", "\\}", "x", " ", "\\frac", "1"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 25))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for r in df.select("t", A.boxed_answer("t").alias("b")).collect():
        assert r.b == by_stack(r.t), r.t


def test_long_and_deep_boxes(spark):
    long = "x" * 1_000_000
    deep = "\\text{" * 50_000 + "7" + "}" * 50_000
    rows = [(0, f"\\boxed{{{long}}}", long), (1, f"\\boxed{{a{{{long}}}}}", f"a{{{long}}}"), (2, f"\\boxed{{{deep}}}", deep),
            (3, "\\boxed{" * 20_000, None), (4, "{" * 300_000 + "\\boxed{1}", "1"), (5, "\\boxed{" + "}{" * 100_000, "")]
    df = spark.createDataFrame([(i, t, "math", "1") for i, t, _ in rows], "sample_id long, prediction string, dataset string, reference string")
    got = {r.sample_id: r.b for r in df.select("sample_id", A.boxed_answer("prediction").alias("b")).collect()}
    for i, _, want in rows:
        assert got[i] == want, i
    g = S.grade(df)
    assert S.error_type(g).count() == S.numeric_match(g).where("numeric_correct is not null").count() == len(rows)
    assert {r.sample_id for r in S.numeric_match(g).where("numeric_correct").collect()} == {4}


def test_depth_fifty_is_read(spark):
    t = "\\boxed{" * 50 + "\\frac{3}{4}" + "}" * 50
    df = spark.createDataFrame([(1, t, "math", "0.75"), (2, t, "math", "0.7")], "sample_id long, prediction string, dataset string, reference string")
    assert {r.sample_id for r in S.numeric_match(S.grade(df)).where("numeric_correct").collect()} == {1}


FRACTIONS = [(r"\frac12", 0.5), (r"\boxed{\frac12}", 0.5), (r"\frac1{4}", 0.25), (r"\frac{3}4", 0.75), (r"\dfrac 34", 0.75), (r"2\frac12", 2.5),
             (r"-1\frac{1}2", -1.5), (r"\tfrac{10}{4}", 2.5), (r"\frac{\text{1}}{2}", 0.5), (r"\frac{}{2}", None), (r"\frac", None)]


def test_fractions_without_braces(spark):
    df = spark.createDataFrame(list(enumerate(t for t, _ in FRACTIONS)), "i int, t string")
    got = {r.i: r.v for r in df.select("i", A.to_number(A.latex_to_plain("t")).alias("v")).collect()}
    for i, (t, want) in enumerate(FRACTIONS):
        assert got[i] == (want if want is None else pytest.approx(want)), t
    both = spark.createDataFrame([("a", r"\boxed{\frac12}", "math", r"\boxed{\frac{1}{2}}")], "sample_id string, prediction string, dataset string, reference string")
    assert S.error_type(S.grade(both)).first().error_type == "format_only"


PLAIN = [(r"\{1, 2\}", "{1,2}"), (r"x^{2}", "x^2"), (r"\mathrm{cm}", "cm"), ("{a}", "a"), ("no markup here", "nomarkuphere"), (r"\frac{\frac{1}{2}}{3}", "(1/2)/3"),
         (r"\text{a {b} c}", "abc"), (r"90^{\circ}", "90"), (r"3 \cdot 4", "3*4")]


def test_plain_text_by_hand(spark):
    df = spark.createDataFrame(list(enumerate(t for t, _ in PLAIN)), "i int, t string")
    got = {r.i: r.p for r in df.select("i", A.latex_to_plain("t").alias("p")).collect()}
    for i, (t, want) in enumerate(PLAIN):
        assert got[i].replace("(", "").replace(")", "") == want.replace("(", "").replace(")", ""), (t, got[i])


UNITS = [("5 km/h", "5"), ("12 sq ft", "12"), ("12 apples", "12"), ("1,250.50 dollars", "1250.50"), ("3 kilograms.", "3"), ("7 m/s^2", "7"), ("9 m/s²", "9"),
         ("5 dog", "5"), ("2 pi", "2 pi"), ("4 sqrt", "4 sqrt"), ("x", "x"), ("dog", "dog"), ("12kmperhour", "12"), ("8sqft", "8"), ("£30", "30"),
         ("30 USD", "30"), ("100°C", "100"), ("6 feet", "6"), ("6 ft.", "6"), ("2 x", "2 x"), ("3ab", "3ab"), ("5 m + 3", "5 m + 3"), ("y = 4 mm", "y = 4"),
         ("1/2 cup", "1/2"), (".5 liters", ".5"), ("-40 degrees", "-40"), ("10 cubic meters per second", "10"), ("%", "%"), ("", ""), (None, None),
         ("15 minutes of fame", "15"), ("3 infinity", "3 infinity")]


def test_units_by_hand(spark):
    df = spark.createDataFrame(list(enumerate(t for t, _ in UNITS)), "i int, t string")
    got = {r.i: r.s for r in df.select("i", A.normalize_number_string("t").alias("s")).collect()}
    for i, (t, want) in enumerate(UNITS):
        assert got[i] == want, (t, got[i])


def test_longest_unit_wins():
    import re

    p = re.compile(A.trie_pattern(["m", "mm", "min", "minute", "minutes", "k"]))
    assert [p.match(w).group() for w in ("m2", "mm", "mins", "minutes", "minute.", "km")] == ["m", "mm", "min", "minutes", "minute", "k"]
    assert len(A.unit_table()) > 300 and "kilometers" in A.unit_table()


def test_units_on_long_texts(spark):
    texts = ["7" + "m" * 200_000, "7 " + "ab " * 100_000, "7" * 200_000 + " km", "1 " * 100_000]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.select(A.normalize_number_string(A.latex_to_plain("t")).alias("s")).where("s is not null").count() == 4


def test_one_prediction_a_reference(spark):
    refs = spark.createDataFrame([("math", 1, "5"), ("math", 2, "6"), ("math", 2, "7"), ("math", 3, "8")], "dataset string, sample_id long, reference string")
    rows = [("math", 1, 1, "5"), ("math", 1, 2, "4"), ("math", 1, 2, "3"), ("math", 2, 9, None), ("math", 2, 3, "6"), ("math", 7, 1, "x"),
            ("math", 1, 0, "5")] + [("math", 1, 0, "9")] * 40
    preds = spark.createDataFrame(rows, "dataset string, sample_id long, attempt int, prediction string")
    for parts in (1, 7):
        got = S.pair(refs, preds.repartition(parts), order=["attempt"], report=True)
        assert sorted((r.sample_id, r.reference, r.prediction, r.n_predictions, r.conflict) for r in got.collect()) == [
            (1, "5", "4", 44, True), (2, "6", "", 2, True), (2, "7", "", 2, True), (3, "8", "", 0, False)]
        plain = S.pair(refs, preds.repartition(parts))
        assert plain.columns == ["dataset", "sample_id", "reference", "prediction"]
        assert sorted((r.sample_id, r.prediction) for r in plain.collect()) == [(1, "9"), (2, "6"), (2, "6"), (3, "")]


def test_reviews_never_change_the_rows(spark):
    graded = spark.createDataFrame([("math", i, i % 2 == 0) for i in range(6)], "dataset string, sample_id long, correct boolean")
    log = spark.createDataFrame([("math", 0, 1, "a", False), ("math", 0, 2, "b", True), ("math", 1, 1, "a", True), ("math", 1, 2, "a", None),
                                 ("math", 2, 1, "a", False), ("math", 2, 1, "a", False), ("math", 3, 5, "a", False), ("math", 3, 5, "b", True),
                                 ("math", 99, 1, "a", True)], "dataset string, sample_id long, version int, reviewer string, verdict boolean")
    got = S.rescore(graded, log, order=["version", "reviewer"], verdict="verdict")
    assert got.columns == [*graded.columns, "rescored"]
    assert sorted((r.sample_id, r.rescored) for r in got.collect()) == [(0, True), (1, False), (2, False), (3, True), (4, True), (5, False)]
    held = {r.sample_id: (r.verdict, r.n_verdicts) for r in S.review_conflicts(log, order=["version", "reviewer"]).collect()}
    assert held == {0: (True, 2), 3: (True, 2)}
    assert S.rescore(graded, log.limit(0), order=["version"], verdict="verdict").where("rescored = correct").count() == 6
