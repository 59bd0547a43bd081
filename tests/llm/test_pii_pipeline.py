"""PII surrogates (7) and the pipeline."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillspark.llm import common as C
from quillspark.llm import pii

SF = "/root/testdata/sf0.001"


def luhn(number):
    digits = [int(c) for c in re.sub("[^0-9]", "", number)][::-1]
    return sum(digits[0::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])


def iban_ok(x):
    x = x.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1


@pytest.fixture(scope="module")
def new(spark):
    """value -> (type, replacement) of many values."""
    import random

    rnd = random.Random(4)
    values = {"jane.doe@mail.example.org", "Jane.doe@mail.example.org", "x@sub.mail.example.org", "17.252.227.210", "255.255.255.255",
              "+1 (632) 555-4827", "(632) 555-4827", "4111 1111 1111 1111", "4111111111111111", "4111111111111112", "123-45-6789",
              "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", 'token = "97ffa88d7c5f5655e365004e29bd123cdabd722a',
              "password=ab03fc4f18ebeb2e70", "password=Correct.Horse", "Mr. John Smith", "Mr Smith", "John Smith", "Frau Müller",
              "Г-жа Иванова", "Anna Kowalska", "Mary Kowalska"}
    values |= {f"{rnd.choice('abc')}{rnd.randint(0, 99)}@h{rnd.randint(0, 9)}.example.com" for _ in range(150)}
    values |= {f"{rnd.randint(1, 255)}.{rnd.randint(0, 9)}.0.{rnd.randint(0, 9)}" for _ in range(150)}
    values |= {f"4{rnd.randint(0, 99):015d}" for _ in range(150)}
    values |= {f"Mr {n}" for n in ("Bo", "Li", "Anna", "Karl", "Peter", "Paul", "James", "John")}
    df = spark.createDataFrame([(v,) for v in sorted(values)], "e string")
    rows = df.select("e", pii.entity_type(F.col("e")).alias("k"), pii.surrogate(F.col("e")).alias("s"),
                     pii.surrogate(F.col("e"), "other key").alias("o")).collect()
    assert all(r.k for r in rows), [r.e for r in rows if not r.k]
    assert sum(r.s != r.o for r in rows) > 0.9 * len(rows)  # keyed
    return {r.e: (r.k, r.s) for r in rows}


def test_distinct_and_same_type(spark, new):
    by_type = {}
    for e, (k, s) in new.items():
        same = e if k != "email" else e.split("@")[0] + "@" + e.split("@")[1].lower()
        by_type.setdefault(k, {}).setdefault(s, set()).add(same)
        assert re.sub(r"\w", "", s, flags=re.U) == re.sub(r"\w", "", e, flags=re.U) or k == "secret", (e, s)
    assert all(len(v) == 1 for t in by_type.values() for v in t.values())
    back = spark.createDataFrame([(s, k) for k, s in new.values()], "s string, k string")
    assert back.where(pii.entity_type(F.col("s")) != F.col("k")).count() == 0


def test_format_and_coreference(new):
    s = {e: x for e, (_, x) in new.items()}
    for e in s:
        if new[e][0] == "card":
            assert (luhn(e) - luhn(s[e])) % 10 == 0 and s[e][0] == e[0] and len(s[e]) == len(e)
        if new[e][0] == "ipv4":
            assert all(0 <= int(o) <= 255 for o in s[e].split("."))
        if new[e][0] == "iban":
            assert iban_ok(e) == iban_ok(s[e]) and s[e][:2] == e[:2]
    smith = s["Mr Smith"].split()[1]
    assert s["Mr. John Smith"].split()[2] == smith == s["John Smith"].split()[1]
    assert s["Mr. John Smith"].split()[1] in pii.GIVEN["male"] and s["Mary Kowalska"].split()[0] in pii.GIVEN["female"]
    assert s["Anna Kowalska"].split()[1] == s["Mary Kowalska"].split()[1]
    assert re.fullmatch("Г-жа [А-ЯЁ][а-яё]+", s["Г-жа Иванова"]) and re.fullmatch(r"Frau [A-Z]\w+", s["Frau Müller"])
    host = s["jane.doe@mail.example.org"].split("@")[1]
    assert host == s["Jane.doe@mail.example.org"].split("@")[1] and host.endswith(".org")
    assert re.fullmatch('token = "[0-9a-f]{40}', s['token = "97ffa88d7c5f5655e365004e29bd123cdabd722a'])
    assert s["+1 (632) 555-4827"].startswith("+1 (")


def test_texts(spark):
    rows = [(1, "write a1@b.example.com, or a1@b.example.com!"), (2, None), (3, ""), (4, "version 3.0 of 2.0, 12 items @ 5"),
            (None, "a1@b.example.com"), (1, "write a1@b.example.com, or a1@b.example.com!"), (5, "x" * 200_000 + " 17.252.227.210")]
    docs = spark.createDataFrame([(i, t, "f", 2) for i, t in rows], "doc_id long, text string, found string, _c0 int")
    out = pii.pseudonymise(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    text = {r.doc_id: r.text for r in out.collect()}
    a, b = re.fullmatch(r"write (\S+), or (\S+)!", text[1]).groups()
    assert a == b == text[None] and "a1@b" not in a
    assert text[2] is None and text[3] == "" and text[4] == rows[3][1]
    assert text[5].startswith("x" * 200_000 + " ") and "17.252.227.210" not in text[5]
    n = {r.doc_id: r.n_entities for r in pii.report(docs).collect()}
    assert n == {1: 2, 2: 0, 3: 0, 4: 0, 5: 1, None: 1}
    assert pii.collisions(docs).count() == 0 and pii.report(docs.limit(0)).count() == 0


def test_only_sql(spark):
    plan = pii.report(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan.replace("ExistingRDD", "") and "Arrow" not in plan


def test_pipeline(spark):
    docs = C.read(spark, SF, "documents")
    total = {}
    for name, stage in corpus_pipeline.STAGES:
        after = C.saved(stage(spark, docs, SF), "t")
        total[name] = after.count()
        if name != "packing":
            assert after.columns == docs.columns
        if name == "n-gram Jaccard join":
            from test_dedup import classes_by_hand
            before = [(r.doc_id, r.text) for r in docs.collect()]
            assert {r.doc_id for r in after.collect()} == {c for _, _, c in classes_by_hand(before, corpus_pipeline.NEAR)}
        docs = after
    assert total["quality rules"] >= total["n-gram Jaccard join"] >= total["benchmark decontamination"] == total["PII"] > 100
    used = docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).orderBy("sequence_id").collect()
    assert [r.sequence_id for r in used] == list(range(len(used))) and all(r.n == 1024 for r in used[:-1])
    nothing = C.read(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        nothing = stage(spark, nothing, SF)
    assert nothing.count() == 0


def test_every_entity_has_a_trigger(spark):
    """Each entity alone is looked at, whatever stands between key word and value."""
    import itertools

    gaps = ["", " ", "\t", "\n", "\r\n", " \t", "\x0b\x0c"]
    found = [f"{word}{q}{a}{sign}{b}{q}CorrectHorse" for word, q, a, sign, b in itertools.product(
        ("password", "API_key"), ("", '"', "'"), gaps, "=:", gaps)]
    found += [f"{t}{dot} Xaver" for t in pii.TITLES for dot in ("", ".")] + [f"{g} Xaver" for g in pii._ALL_GIVEN]
    found += ["a@b.example.com", "17.252.227.210", "DE89 3704 0044 0532 0130 00", "123-45-6789", "(632) 555-4827", "4111111111111111"]
    df = spark.createDataFrame(list(enumerate(found)), "doc_id long, text string")
    assert df.where(~F.col("text").rlike(pii._TRIGGER)).collect() == []
    out = {r.doc_id: r for r in pii.report(df).collect()}
    assert all(r.n_entities == 1 for r in out.values())
    assert not any("CorrectHorse" in r.text for r in out.values())
