"""Training-data entry point, second half: vocabulary, encoding, SFT features,
batches, length statistics, batched generation (G1-G8)."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..functions.answers import NUMBER
from ..functions.text import WS_CLASS
from ..operators import features as FT
from ..operators import sampling as SM
from ..session import saved
from . import sqltext as Q
from .prompting_q import CONFIGS, QA_VIEWS, eval_samples, rendered_union
from .registry import query

EVAL_BATCH = 4                       # eval batch size
TRAIN_BATCH = 16                     # per-device 1 x accumulation 16
CAPS = {c.name: (c.max_source_length, c.max_target_length) for c in CONFIGS}
KEYS = ["dataset", "conv_id", "turn"]


def _cap_col(which: int):
    expr = F.lit(0)
    for name, caps in sorted(CAPS.items()):
        expr = F.when(F.col("dataset") == name, F.lit(caps[which])).otherwise(expr)
    return expr


def vocab_for(spark, sf_dir):
    # written once: the vocabulary, the positions and the encoding all read it
    recs = saved(rendered_union(spark, sf_dir), "rendered")
    return recs, FT.build_vocab(recs, ["prompt", "response"])


def encoded(spark, sf_dir):
    recs, vocab = vocab_for(spark, sf_dir)
    enc = FT.encode_many(recs, {"prompt_ids": ("prompt", _cap_col(0)), "response_ids": ("response", _cap_col(1))},
                         vocab, KEYS, carry=["split"])
    return enc, vocab


def features(spark, sf_dir, eos: bool = True):
    enc, vocab = encoded(spark, sf_dir)
    if eos:
        enc = enc.withColumn("response_ids", FT.append_eos("response_ids", vocab.eos_id))
    return FT.sft_features(enc, "prompt_ids", "response_ids"), vocab


def ids_text(c):
    return F.array_join(F.col(c).cast("array<string>"), " ")


# ---- SQL -------------------------------------------------------------------

def words_sql(e):
    t = Q.pystrip(e)
    return f"CASE WHEN {t} = '' THEN []::VARCHAR[] ELSE string_split_regex({t}, {Q.lit(WS_CLASS + '+')}) END"


def _cap_sql(which):
    return "CASE dataset " + " ".join(f"WHEN '{n}' THEN {c[which]}" for n, c in sorted(CAPS.items())) + " ELSE 0 END"


VOCAB_SQL = f"""
SELECT token, id FROM (VALUES ('<pad>', 0), ('<s>', 1), ('</s>', 2), ('<unk>', 3)) v(token, id)
UNION ALL
SELECT token, CAST(rn + 3 AS INT) AS id FROM (
  SELECT token, row_number() OVER (ORDER BY n DESC, token) AS rn FROM (
    SELECT token, count(*) AS n FROM (
      SELECT unnest({words_sql('prompt')}) AS token FROM rendered
      UNION ALL SELECT unnest({words_sql('response')}) AS token FROM rendered)
    WHERE token NOT IN ('<pad>', '<s>', '</s>', '<unk>') GROUP BY token))
"""


def _enc_sql(text, capw, name):
    return f"""
{name}_tok AS (SELECT dataset, conv_id, turn, cap, unnest(w) AS token, generate_subscripts(w, 1) - 1 AS pos
   FROM (SELECT dataset, conv_id, turn, {_cap_sql(capw)} AS cap, {words_sql(text)} AS w FROM rendered)),
{name}_agg AS (SELECT t.dataset, t.conv_id, t.turn, list(coalesce(v.id, 3) ORDER BY t.pos) AS ids
   FROM {name}_tok t LEFT JOIN vocab v ON v.token = t.token WHERE t.pos < t.cap - 1
   GROUP BY t.dataset, t.conv_id, t.turn),
{name}_enc AS (SELECT r.dataset, r.conv_id, r.turn,
   list_slice(list_concat([1], coalesce(a.ids, []::INT[])), 1, {_cap_sql(capw).replace('dataset', 'r.dataset')}) AS ids,
   CAST(len({words_sql('r.' + text)}) + 1 AS INT) AS full_len
   FROM rendered r LEFT JOIN {name}_agg a ON a.dataset = r.dataset AND a.conv_id = r.conv_id AND a.turn = r.turn)"""


ENC_CTES = ("WITH " + ",\n".join(f"{k} AS ({v})" for k, v in QA_VIEWS.items())
            + f",\nvocab AS ({VOCAB_SQL})," + _enc_sql("prompt", 0, "p") + "," + _enc_sql("response", 1, "r"))

FEAT_SQL = """
feat AS (SELECT p.dataset, p.conv_id, p.turn, q.split, p.ids AS prompt_ids, p.full_len AS prompt_full_len,
   CASE WHEN len(r.ids) = 0 OR r.ids[-1] <> 2 THEN list_concat(r.ids, [2]) ELSE r.ids END AS response_ids,
   r.full_len AS response_full_len
   FROM p_enc p JOIN r_enc r USING (dataset, conv_id, turn) JOIN rendered q USING (dataset, conv_id, turn))
"""


@query("vocab", Q.with_views(f"SELECT token, id FROM vocab", **QA_VIEWS, vocab=VOCAB_SQL))
def vocab(spark, sf_dir):
    return vocab_for(spark, sf_dir)[1].table


@query("encode", ENC_CTES + """
SELECT dataset, conv_id, turn, array_to_string(ids, ' ') AS prompt_ids, full_len AS prompt_ids_full_len FROM p_enc
""")
def encode(spark, sf_dir):
    recs, vocab = vocab_for(spark, sf_dir)
    recs = recs.withColumn("_src", _cap_col(0))
    p = FT.encode(recs, "prompt", vocab, F.col("_src"), KEYS, "prompt_ids")
    return p.select(*KEYS, ids_text("prompt_ids").alias("prompt_ids"), "prompt_ids_full_len")


@query("sft_features", ENC_CTES + "," + FEAT_SQL + """
SELECT dataset, conv_id, turn, array_to_string(list_concat(prompt_ids, response_ids), ' ') AS input_ids,
       array_to_string(list_concat(list_resize([]::INT[], len(prompt_ids), -100), response_ids), ' ') AS labels,
       CAST(len(prompt_ids) + len(response_ids) AS INT) AS n_input, CAST(len(prompt_ids) AS INT) AS n_prompt
FROM feat
""")
def sft_features(spark, sf_dir):
    f, _ = features(spark, sf_dir)
    return f.select(*KEYS, ids_text("input_ids").alias("input_ids"), ids_text("labels").alias("labels"),
                    F.size("input_ids").alias("n_input"), F.size("prompt_ids").alias("n_prompt"))


def _pos_key_sql():
    return (f"md5(concat_ws('#', '{SM.DEFAULT_SEED}', dataset, CAST(conv_id AS VARCHAR), "
            f"CAST(turn AS VARCHAR)))")


@query("batches", ENC_CTES + "," + FEAT_SQL + f""",
tr AS (SELECT *, list_concat(prompt_ids, response_ids) AS input_ids,
         CAST((row_number() OVER (ORDER BY {_pos_key_sql()}, dataset, conv_id, turn) - 1) // {TRAIN_BATCH} AS BIGINT) AS batch_id
       FROM feat WHERE split = 'train'),
padded AS (SELECT *, max(len(input_ids)) OVER (PARTITION BY batch_id) AS m FROM tr)
SELECT batch_id, dataset, conv_id, turn,
       array_to_string(list_resize(input_ids, m, 0), ' ') AS input_ids,
       CAST(m AS INT) AS n_padded, CAST(m - len(input_ids) AS INT) AS n_pad
FROM padded
""")
def batches(spark, sf_dir):
    recs, vocab = vocab_for(spark, sf_dir)
    # F1 positions depend only on the ids, so they are ranked on the rendered
    # train records (cheap) and ride through the one-pass encoding
    train = SM.seeded_shuffle(recs.where(F.col("split") == "train"), SM.DEFAULT_SEED, KEYS)
    enc = FT.encode_many(train, {"prompt_ids": ("prompt", _cap_col(0)),
                                 "response_ids": ("response", _cap_col(1))},
                         vocab, KEYS, carry=["split", "position"])
    enc = enc.withColumn("response_ids", FT.append_eos("response_ids", vocab.eos_id))
    f = FT.sft_features(enc, "prompt_ids", "response_ids")
    # A10: feature sets are written once (split/dataset folders) and batching
    # reads them back, so a lost executor never re-tokenises the corpus
    f = saved(f.select(*KEYS, "split", "position", "input_ids", "attention_mask", "labels"),
              "features", ["split", "dataset"])
    b = FT.pad_batch(FT.assign_batches(f, TRAIN_BATCH), vocab.pad_id)
    return b.select("batch_id", *KEYS, ids_text("input_ids").alias("input_ids"),
                    F.size("input_ids").alias("n_padded"),
                    (F.size("attention_mask") - F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x))
                    .alias("n_pad"))


@query("length_stats", ENC_CTES + "," + FEAT_SQL + f"""
SELECT dataset, CAST(count(*) AS BIGINT) AS n, CAST(max(prompt_full_len) AS BIGINT) AS max_prompt_len,
       CAST(max(response_full_len) AS BIGINT) AS max_response_len,
       round(avg(prompt_full_len), 6) AS mean_prompt_len,
       CAST(count_if(prompt_full_len > {_cap_sql(0)}) AS BIGINT) AS n_prompt_truncated,
       CAST(count_if(response_full_len > {_cap_sql(1)}) AS BIGINT) AS n_response_truncated
FROM feat GROUP BY dataset
""")
def length_stats(spark, sf_dir):
    f, _ = features(spark, sf_dir)
    return FT.token_length_stats(f, CAPS)


_NUM = re.compile(NUMBER)


def last_number_answer(prompts: list[str]) -> list[str]:
    """A stand-in generator: answers with the last number in the prompt."""
    out = []
    for p in prompts:
        nums = [m.group(0) for m in _NUM.finditer(p)]
        out.append(f"Answer: {nums[-1]}" if nums else "")
    return out


@query("batch_predict", Q.with_views(f"""
SELECT dataset, conv_id, turn,
  CASE WHEN len(regexp_extract_all(prompt, {Q.lit(NUMBER)}, 0)) > 0
       THEN concat('Answer: ', list_extract(regexp_extract_all(prompt, {Q.lit(NUMBER)}, 0), -1)) ELSE '' END AS prediction
FROM rendered r JOIN (SELECT dataset, max(CASE WHEN split = 'test' THEN 1 ELSE 0 END) AS has_test FROM rendered GROUP BY dataset) h
  USING (dataset)
WHERE split = CASE WHEN has_test = 1 THEN 'test' ELSE 'validation' END
""", **QA_VIEWS))
def batch_predict(spark, sf_dir):
    ev = eval_samples(spark, sf_dir)
    return FT.batch_predict(ev, last_number_answer, EVAL_BATCH, KEYS)
