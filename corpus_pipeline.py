"""Corpus pipeline: quality rules, near-duplicate removal, benchmark
decontamination, PII surrogates, packing.

Each stage gets all rows its predecessor kept, as a table; all but the last
return the columns of ``documents``.  ``run`` writes every stage's result under
the shared folder, so a lost executor repeats at most one stage.

No stage can be told in SQL as a whole (fitted weights, a tokenizer), so
``ORACLE_SQL`` is None; tests compare the stages with brute force.
"""

from __future__ import annotations

from quillspark.llm import common as C
from quillspark.llm import decontam, jaccard_join, packing, pii, quality_rules

#: Near duplicates: five-word shingles, similarity 0.8 or more.
NEAR = jaccard_join.Rule(words=5, num=80, den=100)


def quality(spark, docs, sf_dir):
    """Rows that pass the rules (operator 10); the trusted and the toxic texts are
    the labelled rows of ``documents``, the raw corpus is ``docs``."""
    weights, toxicity = quality_rules.learn(
        C.plain(docs, "doc_id", "text"), C.plain(C.read(spark, sf_dir, "documents"), "doc_id", "text"), C.read(spark, sf_dir, "labels"))
    return quality_rules.keep_good(docs, weights, toxicity=toxicity)


def near_duplicates(spark, docs, sf_dir):
    """One row of each class of near duplicates (operator 9)."""
    return jaccard_join.keep_one(docs, NEAR)


def decontamination(spark, docs, sf_dir):
    """Rows without a benchmark window (operator 2)."""
    return decontam.remove_documents(docs, C.read(spark, sf_dir, "benchmark"))


def surrogates(spark, docs, sf_dir):
    """Every row, with surrogates for personal data (operator 7)."""
    return pii.pseudonymise(docs)


def packed(spark, docs, sf_dir):
    """Pieces of packed sequences, with their ids (operator 4)."""
    import public_tokenizers

    return packing.pack(C.plain(docs, "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"), ids=True, literal=False)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", surrogates),
    ("packing", packed),
]
ORACLE_SQL = None


def run(spark, sf_dir):
    """The last stage's rows for ``documents`` of ``sf_dir``."""
    docs = C.read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = C.saved(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs
