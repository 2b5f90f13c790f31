"""The corpus pipeline: toxic texts, exact copies, near copies and benchmark passages go, the rest is packed.

STAGES lists the steps; each takes (spark, docs, sf_dir) and works on all that the step before it
kept. run() applies them to `documents`, writing each step's result as Parquet to the shared
folder and reading it again, so that a lost executor costs no more than the step it was in.

Nulls: a text without content is kept by every filter but the copies' (all empty texts are
copies of each other). Rows without a doc_id are kept by the same rules. Extra columns are
carried through all steps but the last, which returns the packed pieces.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from touchline.llm import content_sort, decontaminate, ngram_join, packing, pu_toxicity
from touchline.llm.queries import read_table
from touchline.session import settle

#: Shingles and similarity in hundredths of the near_dedup stage; op1 has its own.
NEAR_WORDS, NEAR_SIMILAR = 5, 80


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier calls toxic; it is trained on the stage's own input."""
    return pu_toxicity.drop_toxic(docs, pu_toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the largest doc_id of equal texts."""
    return content_sort.drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group that links of Jaccard NEAR_SIMILAR hundredths connect."""
    return ngram_join.drop_near_copies(docs, n_words=NEAR_WORDS, similar=NEAR_SIMILAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold too much of the benchmark."""
    return decontaminate.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of what is left, packed into sequences."""
    pieces = packing.cut_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack_pieces(settle(pieces))


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", pack),
]

#: Trained scores and tokens have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
