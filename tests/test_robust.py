"""Repeated keys and odd numbers in JSON, feature reuse, encoding by content,
hot conversations, buckets that follow the data."""

import json
import math
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quillspark.operators import features as FT
from quillspark.operators import prompts as P
from quillspark.operators import sampling as SM
from quillspark.sources import jsonl, sinks

LINES = ['{"a": 1, "a": 2}', '{"a": NaN}', '{"a": -Infinity, "b": [Infinity]}', '{"a": {"b": 1, "b": {"c": 3}}}', '[1, 2]', '"text"', "7", "null",
         ' {"a": "x"} ', '{"a": "\\u00e9 ]"}', '{"é": "]["}',
         # malformed
         '{"a": 1} x', '{"a": 1}{"b": 2}', "{'a': 1}", '{"a": 1,}', '{"a": 01}', "nul", '{"a":', "1],[2", '{"a":1},{"b":2}', "{a: 1}", '1, "end of line"']


def python_value(line):
    try:
        return True, json.loads(line)
    except ValueError:
        return False, None


def plain(v):
    """JSON numbers and non-numbers in one spelling."""
    if isinstance(v, dict):
        return {k: plain(x) for k, x in v.items()}
    if isinstance(v, list):
        return [plain(x) for x in v]
    if isinstance(v, float) and not math.isfinite(v):
        return {"nan": "NaN", "inf": "Infinity", "-inf": "-Infinity"}[str(v)]
    return v


def test_lines_as_python_reads_them(spark):
    df = spark.createDataFrame(list(enumerate(LINES)), "i int, raw string")
    rows = {r.i: (r.ok, r.j) for r in jsonl.parse_lines(df, mode="PERMISSIVE").select(
        "i", F.col("record").isNotNull().alias("ok"), F.to_json("record").alias("j")).collect()}
    for i, line in enumerate(LINES):
        ok, value = python_value(line)
        assert rows[i][0] == ok, line
        if ok:
            assert json.loads(rows[i][1]) == plain(value), line


def test_malformed_lines_raise(spark, tmp_path):
    path = str(tmp_path / "x.jsonl")
    with open(path, "w") as f:
        f.write('{"a": 1, "a": NaN}\n \n\t\n{"a": 2}\n')
    assert jsonl.read_jsonl_variant(spark, path).count() == 2
    jsonl.read_jsonl_variant(spark, path).select(F.to_json("record")).collect()
    for bad in ('{"a": 1} x', '{"a":'):
        with open(path, "a") as f:
            f.write(bad + "\n")
        with pytest.raises(Exception):
            jsonl.read_jsonl_variant(spark, path).select(F.to_json("record")).collect()
    with pytest.raises(ValueError):
        jsonl.read_jsonl_variant(spark, path, mode="LOOSE")


def test_features_are_reused(spark, tmp_path):
    src, root = str(tmp_path / "src"), str(tmp_path / "cache")
    spark.range(20).write.parquet(src)
    built = []

    def build():
        built.append(1)
        return spark.read.parquet(src).select(F.lit("train").alias("split"), F.when(F.col("id") % 2 == 0, "01").otherwise("02").alias("dataset"), "id")

    def get(settings):
        df, reused = sinks.cached_features(spark, root, settings, [src], build)
        return sorted(map(tuple, df.collect())), reused

    rows, reused = get({"cap": 5})
    assert not reused and len(rows) == 20 and {r[1] for r in rows} == {"01", "02"}  # partition values keep their type
    assert get({"cap": 5}) == (rows, True) and len(built) == 1
    assert get({"cap": 6}) == (rows, False) and len(built) == 2
    spark.range(5).write.mode("append").parquet(src)  # the input changed
    assert len(get({"cap": 5})[0]) == 25 and len(built) == 3
    assert get({"cap": 5})[1] and len(built) == 3


def test_half_written_features_are_not_read(spark, tmp_path):
    src, root = str(tmp_path / "src"), str(tmp_path / "cache")
    spark.range(3).write.parquet(src)

    def bad():
        return spark.range(3).select(F.lit("a").alias("split"), F.lit("b").alias("dataset"), F.raise_error(F.lit("lost")).cast("long").alias("id"))

    def good():
        return spark.range(3).select(F.lit("a").alias("split"), F.lit("b").alias("dataset"), "id")

    with pytest.raises(Exception):
        sinks.cached_features(spark, root, {}, [src], bad)
    entry = f"{root}/{sinks.cache_key({}, sinks.input_state(spark, [src]))}"
    os.makedirs(f"{entry}/rows-0000", exist_ok=True)  # a writer that died, first by name
    df, reused = sinks.cached_features(spark, root, {}, [src], good)
    assert not reused and df.count() == 3
    assert sinks.cached_features(spark, root, {}, [src], bad)[1]
    # a second writer's mark changes nothing for readers of the first
    marks = [json.loads(r.value)["rows"] for r in spark.read.text(f"{entry}/committed").collect()]
    assert len(marks) == 1


def vocab_by_hand(rows, cols):
    n = Counter(w for r in rows for c in cols for w in (r[c] or "").split())
    words = sorted(n, key=lambda w: (-n[w], w))
    return {w: i + 4 for i, w in enumerate(words)}


def test_encoding_knows_rows_by_content(spark):
    rnd = random.Random(1)
    words = [f"w{i}" for i in range(30)]
    texts = [" ".join(rnd.choices(words, k=rnd.randint(0, 9))) for _ in range(12)] + ["", None]
    rows = [(rnd.choice([1, 2, None]), rnd.choice(texts), rnd.choice(texts), rnd.choice(["a", "b"])) for _ in range(80)]
    rows += [rows[0]] * 50  # equal rows come out as often as they went in
    schema = "id int, p string, r string, note string"
    ids = vocab_by_hand([dict(zip(("id", "p", "r", "note"), x)) for x in rows], ["p", "r"])

    def enc(t, cap):
        return tuple(([1] + [ids[w] for w in (t or "").split()])[:cap])

    want = Counter((i, note, enc(p, 4), len((p or "").split()) + 1, enc(r, 6), len((r or "").split()) + 1) for i, p, r, note in rows)
    seen = []
    for seed, parts in ((0, 1), (1, 3), (2, 8)):  # the input in another order and layout each time
        own = list(rows)
        random.Random(seed).shuffle(own)
        df = spark.createDataFrame(own, schema).repartition(parts)
        vocab = FT.build_vocab(df, ["p", "r"])
        out = FT.encode_many(df, {"pi": ("p", 4), "ri": ("r", 6)}, vocab, ["id"], carry=["note"])
        seen.append(Counter((x.id, x.note, tuple(x.pi), x.pi_full_len, tuple(x.ri), x.ri_full_len) for x in out.collect()))
    assert seen[0] == seen[1] == seen[2] == want


def test_encoding_does_not_depend_on_task_order(spark):
    """The row's name is a function of what it brings."""
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "c")], "id int, t string")
    for parts in (1, 2, 3):
        named = df.repartition(parts).select("*", *[h.alias(f"h{i}") for i, h in enumerate(FT._content(df, ["id", "t"]))])
        assert len({(r.id, r.h0, r.h1) for r in named.collect()}) == 2
    plan = FT.encode(df, "t", FT.build_vocab(df, ["t"]), 5, ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "monotonically_increasing_id" not in plan


def test_hot_conversation_in_blocks(spark):
    rnd = random.Random(2)
    rows = [("hot", i, f"t{i}") for i in range(5000)] + [(f"c{i % 40}", i // 40, None if i % 7 == 0 else f"x{i}") for i in range(900)] + [(None, 3, "n")]
    rows += [("same", 1, t) for t in ("b", "a", "c")] + [("neg", i, str(i)) for i in range(-30, 30)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id string, turn long, text string").repartition(6)
    want = {}
    for c, t, x in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2] or "")):
        want.setdefault(c, []).append(x or "")
    got = {r.conv_id: (r.n_turns, r.chat_text) for r in P.join_turns(df, width=16).collect()}
    assert got == {c: (len(t), "\n\n".join(t)) for c, t in want.items()}
    blocks = P.turn_blocks(df, width=16)
    assert blocks.where("conv_id = 'hot'").count() == 313 and blocks.agg(F.max("n_turns")).first()[0] == 16
    assert P.join_turns(df.where("conv_id = 'neg'"), max_bytes=10_000).count() == 1
    with pytest.raises(Exception, match="conversation hot has a chat text of 33888 bytes, more than 10000"):
        P.join_turns(df, max_bytes=10_000).collect()


@pytest.mark.parametrize("rows, most", [(5000, 100), (5000, 10_000), (3000, 1), (0, 10)])
def test_buckets_follow_the_data(spark, rows, most):
    df = spark.range(rows).select(F.lit("d").alias("dataset"), F.col("id").alias("sample_id"))
    keyed = df.withColumn("_key", SM.hash_key(1, "sample_id"))
    sizes = [r["count"] for r in SM.with_bucket(keyed, "_key", most).groupBy("_bucket").count().collect()]
    # a hash spreads as a Poisson count does around its mean, which is at most ``most``
    assert all(n <= most + 6 * most ** 0.5 + 6 for n in sizes)
    assert len(sizes) <= max(1, 16 * rows / most)
    got = SM.seeded_shuffle(df, 1, ["sample_id"], bucket_rows=most).orderBy("position").collect()
    keys = [r["_key"] for r in keyed.orderBy("_key", "sample_id").collect()]
    own = {r["sample_id"]: r["_key"] for r in keyed.collect()}
    assert [r.position for r in got] == list(range(rows)) and [own[r.sample_id] for r in got] == keys


def test_ranks_with_null_groups_and_small_buckets(spark):
    rows = [(g, i) for i in range(600) for g in ("a", None, "b")[: 1 + i % 3]]
    df = spark.createDataFrame(rows, "g string, sample_id long").withColumn("_key", SM.hash_key(3, "sample_id"))
    got = SM.hash_rank(df, ["g"], "_key", ["sample_id"], bucket_rows=10)
    by = {}
    for r in got.collect():
        by.setdefault(r.g, []).append((r["_key"], r.sample_id, r["rank"]))
    for own in by.values():
        assert [x[2] for x in sorted(own)] == list(range(1, len(own) + 1))
    assert {g: len(v) for g, v in by.items()} == {"a": 600, None: 400, "b": 200}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan.lower().replace("broadcasthint", "broadcast") or "strategy=broadcast" not in plan
