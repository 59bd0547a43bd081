"""Token features for supervised fine-tuning.

The vocabulary is built by Spark from the corpus (a stand-in for a loaded
tokeniser): whitespace-separated words, most frequent first, special ids in
front.  It holds every word; ``max_size`` limits it only when a caller asks.
Its ``HEAD`` most frequent words - a fixed number - are joined by broadcast, so
that hot words never shuffle; the rest is an ordinary join on the word.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import WS_CLASS, col_of, pystrip
from ..session import literal_table, saved

# --- fixed values: special tokens, label mask value ------------------------
DEFAULT_SPECIALS = ("<pad>", "<s>", "</s>", "<unk>")
IGNORE_INDEX = -100
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class Vocab:
    """Driver-side description of a vocabulary table ``(token, id)``."""
    table: DataFrame
    bos_id: int
    eos_id: int
    unk_id: int
    pad_id: int
    max_size: int | None


#: Words joined by broadcast: the most frequent ones, whatever the vocabulary's size.
HEAD = 20_000


def words(text) -> Column:
    """Whitespace tokens of a text (Python ``str.split()`` semantics); none for null."""
    t = pystrip(F.coalesce(col_of(text), F.lit("")))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, WS_CLASS + "+"))


def build_vocab(texts: DataFrame, text_cols: Sequence[str], max_size: int | None = None,
                specials: Sequence[str | None] = DEFAULT_SPECIALS) -> Vocab:
    """G1: token -> id.  Specials (pad, bos, eos, unk) take the first ids; a
    missing pad falls back to eos.  Remaining ids go to all other tokens, most
    frequent first (ties by token); with ``max_size`` only to so many that it
    holds ids in all.

    Ranks are distributed: a range exchange by (count, token), the index inside
    each range partition, and the partitions' offsets (one row a partition).
    The ranked table is written, so ids stay when an executor is lost.
    """
    pad, bos, eos, unk = specials
    named = [s for s in (pad, bos, eos, unk) if s is not None]
    spark = texts.sparkSession
    toks = texts.select(F.explode(F.flatten(F.array(*[words(c) for c in text_cols]))).alias("token"))
    counts = toks.where(~F.col("token").isin(named)).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    order = [F.desc("n"), F.asc("token")]
    # the low 33 bits of the running id are the row's index in its partition
    dealt = counts.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "token", F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at"))
    dealt = saved(dealt, "vocab-ranks")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    # one row for each range partition
    ranked = dealt.join(F.broadcast(offsets), "part").select(
        "token", (F.col("before") + F.col("at") + len(named)).cast("int").alias("id"))
    if max_size is not None:
        ranked = ranked.where(F.col("id") < max_size)
    special_df = literal_table(spark, [(s, i) for i, s in enumerate(named)], "token string, id int")
    ids = {s: i for i, s in enumerate(named)}
    eos_id = ids[eos]
    return Vocab(special_df.unionByName(ranked), ids[bos], eos_id, ids[unk],
                 ids[pad] if pad is not None else eos_id, max_size)


def encode(df: DataFrame, text_col: str, vocab: Vocab, max_len: int | Column, id_cols: Sequence[str],
           out_col: str = "ids", add_bos: bool = True) -> DataFrame:
    """Text -> ids (bos first), truncated to ``max_len`` ids; also
    ``<out_col>_full_len``, the id count before truncation (for G7)."""
    return encode_many(df, {out_col: (text_col, max_len)}, vocab, id_cols, add_bos=add_bos)


def _content(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of the columns' values: of the JSON of nested ones, and of
    which are null, as a hash passes over nulls."""
    def plain(c: str) -> Column:
        kind = df.schema[c].dataType.simpleString()
        nested = any(k in kind for k in ("<", "variant"))
        return F.to_json(F.struct(F.col(c)), {"ignoreNullFields": "false"}) if nested else F.col(c)

    values = [x for c in cols for x in (plain(c), F.col(c).isNull())]
    return [F.xxhash64(F.lit(salt), *values) for salt in ("one", "two")]


def encode_many(df: DataFrame, texts: dict[str, tuple[str, int | Column]], vocab: Vocab,
                id_cols: Sequence[str], carry: Sequence[str] = (), add_bos: bool = True) -> DataFrame:
    """G2 for several text columns in one pass, row by row (rows with equal ids
    stay apart).

    ``texts`` maps an output name to ``(text column, max_len)``.  A row is known
    by its content (128 bits of hash over everything it brings), never by its
    place in a partition: a task that is run again with its input in another
    order says the same.  Equal rows are one row with a count, put out as often.

    Every row is laid out as one line with its other columns and one line per
    token that survives truncation, so that nothing but (row, field, position,
    token) meets the vocabulary: frequent words by broadcast, the others by
    token.  One aggregate puts the rows together again.  ``carry`` columns ride
    along.  For each output ``o`` the result has ``o`` (ids) and ``o_full_len``
    (ids before truncation).
    """
    keep, names, first = list(dict.fromkeys([*id_cols, *carry])), list(texts), int(add_bos)
    caps = {f"_cap{i}": (F.lit(cap) if isinstance(cap, int) else cap).cast("int") for i, (_, cap) in enumerate(texts.values())}
    laid = df.select(*keep, *[F.col(c).alias(f"_text{i}") for i, (c, _) in enumerate(texts.values())], *[c.alias(n) for n, c in caps.items()])
    h1, h2 = _content(laid, laid.columns)
    laid = laid.select("*", h1.alias("_h1"), h2.alias("_h2"), *[words(f"_text{i}").alias(f"_w{i}") for i in range(len(names))])
    rest = F.struct(*keep, *caps, *[F.size(f"_w{i}").alias(f"_n{i}") for i in range(len(names))])
    none = F.when(F.lit(False), rest)

    def lines(i: int) -> Column:
        cut = F.slice(F.col(f"_w{i}"), F.lit(1), F.greatest(F.col(f"_cap{i}") - first, F.lit(0)))
        return F.transform(cut, lambda w, k: F.struct(F.lit(i).alias("f"), k.alias("pos"), w.alias("token"), none.alias("rest")))

    head_line = F.array(F.struct(F.lit(-1).alias("f"), F.lit(-1).alias("pos"), F.lit(None).cast("string").alias("token"), rest.alias("rest")))
    ex = laid.select("_h1", "_h2", F.explode(F.concat(head_line, *[lines(i) for i in range(len(names))])).alias("_t"))
    ex = ex.select("_h1", "_h2", F.col("_t.f").alias("_f"), F.col("_t.pos").alias("_pos"), F.col("_t.token").alias("token"), F.col("_t.rest").alias("_rest"))

    head = vocab.table.where(F.col("id") < HEAD).withColumnsRenamed({"id": "_head"})
    tail = vocab.table.where(F.col("id") >= HEAD).withColumnsRenamed({"token": "_word", "id": "_tail"})
    j = ex.join(F.broadcast(head), "token", "left")
    # words already found get a key that matches nothing and is not the same for all
    key = F.when(F.col("_head").isNull() & F.col("token").isNotNull(), F.col("token")).otherwise(
        F.concat(F.lit(" "), F.col("_h1").cast("string")))
    j = j.join(tail, key == F.col("_word"), "left")
    tok_id = F.coalesce("_head", "_tail", F.lit(vocab.unk_id))
    # a set: equal rows bring every (field, position) again
    rows = j.groupBy("_h1", "_h2").agg(
        F.first("_rest", ignorenulls=True).alias("_rest"), F.count_if(F.col("_f") < 0).alias("_copies"),
        F.array_sort(F.collect_set(F.when(F.col("_f") >= 0, F.struct("_f", "_pos", tok_id.alias("id"))))).alias("_s"))

    def ids_of(i: int) -> Column:
        return F.transform(F.filter("_s", lambda s: s["_f"] == i), lambda s: s["id"])

    out = []
    for i, name in enumerate(names):
        ids = ids_of(i)
        if add_bos:
            ids = F.concat(F.array(F.lit(vocab.bos_id)), ids)
        out += [F.slice(ids, F.lit(1), F.col(f"_rest._cap{i}")).alias(name), (F.col(f"_rest._n{i}") + first).cast("int").alias(f"{name}_full_len")]
    rows = rows.select(*[F.col(f"_rest.`{c}`").alias(c) for c in keep], *out, "_copies")
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies")))).drop("_copies", "_copy")


def append_eos(ids, eos_id: int) -> Column:
    """Add eos unless the sequence already ends with it (after truncation)."""
    c = col_of(ids)
    return F.when((F.size(c) == 0) | (F.element_at(c, -1) != F.lit(eos_id)),
                  F.concat(c, F.array(F.lit(eos_id)))).otherwise(c)


def sft_features(df: DataFrame, prompt_ids: str, response_ids: str) -> DataFrame:
    """input_ids = prompt + response; mask of ones; labels mask the prompt."""
    p, r = F.col(prompt_ids), F.col(response_ids)
    inp = F.concat(p, r)
    return df.withColumns({
        "input_ids": inp,
        "attention_mask": F.array_repeat(F.lit(1), F.size(inp)),
        "labels": F.concat(F.array_repeat(F.lit(IGNORE_INDEX), F.size(p)), r),
    })


def assign_batches(df: DataFrame, batch_size: int, position: str = "position") -> DataFrame:
    """Consecutive positions form batches."""
    return df.withColumn("batch_id", F.floor(F.col(position) / F.lit(batch_size)).cast("bigint"))


def pad_batch(df: DataFrame, pad_id: int, batch: str = "batch_id") -> DataFrame:
    """Pad every sequence to the longest in its batch (mask 0, labels -100).

    The window is partitioned by batch, so each window group is one batch.
    """
    longest = F.max(F.size("input_ids")).over(Window.partitionBy(batch))
    d = df.withColumn("_pad", longest - F.size("input_ids"))
    return d.withColumns({
        "input_ids": F.concat("input_ids", F.array_repeat(F.lit(pad_id), F.col("_pad"))),
        "attention_mask": F.concat("attention_mask", F.array_repeat(F.lit(0), F.col("_pad"))),
        "labels": F.concat("labels", F.array_repeat(F.lit(IGNORE_INDEX), F.col("_pad"))),
    }).drop("_pad")


def token_length_stats(df: DataFrame, caps: dict[str, tuple[int, int]], dataset: str = "dataset",
                       prompt_len: str = "prompt_ids_full_len", response_len: str = "response_ids_full_len"
                       ) -> DataFrame:
    """Lengths and truncation counts per dataset against its (source, target) caps."""
    src_cap = F.lit(0)
    tgt_cap = F.lit(0)
    for name, (s, t) in sorted(caps.items()):
        src_cap = F.when(F.col(dataset) == name, F.lit(s)).otherwise(src_cap)
        tgt_cap = F.when(F.col(dataset) == name, F.lit(t)).otherwise(tgt_cap)
    return df.groupBy(dataset).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(prompt_len).cast("bigint").alias("max_prompt_len"),
        F.max(response_len).cast("bigint").alias("max_response_len"),
        F.round(F.avg(prompt_len), 6).alias("mean_prompt_len"),
        F.count_if(F.col(prompt_len) > src_cap).alias("n_prompt_truncated"),
        F.count_if(F.col(response_len) > tgt_cap).alias("n_response_truncated"))


def batch_predict(df: DataFrame, fn: Callable[[list[str]], list[str]], batch_size: int,
                  id_cols: Sequence[str], prompt: str = "prompt", out: str = "prediction") -> DataFrame:
    """Run a caller-supplied ``fn(prompts) -> outputs`` over batches of
    ``batch_size`` prompts, one output per input.

    Arrow-batched ``mapInPandas``; each task handles its partition's batches,
    so the work spreads over the cluster and nothing passes the driver.
    """
    id_cols = list(id_cols)
    schema_fields = [df.schema[c] for c in id_cols]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema_fields) + f", `{out}` string"

    def run(it):
        for pdf in it:
            prompts = ["" if p is None else str(p) for p in pdf[prompt].tolist()]
            outs: list[str] = []
            for start in range(0, len(prompts), batch_size):
                part = prompts[start:start + batch_size]
                got = list(fn(part))
                if len(got) != len(part):
                    raise ValueError("batch function must return one output per prompt")
                outs += got
            res = pdf[id_cols].copy()
            res[out] = pd.Series(outs, index=pdf.index, dtype=object)
            yield res

    return df.select(*id_cols, prompt).mapInPandas(run, ddl)
